"""The same results as DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from formweave.operators.extract import CHINESE_PROVINCES
from formweave.queries import tables as Q

# White space of any script, for RE2.
SP = (
    r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NONSP = SP.replace("[", "[^", 1)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def written(day: str, number: str) -> str:
    forms = ["%Y-%m-%d", "%Y/%-m/%-d", "%-m-%-d-%Y", "%m/%d/%Y", "%Y年%-m月%-d日", "%-d.%-m.%Y"]
    cases = " ".join(f"WHEN {i} THEN strftime({day}, '{f}')" for i, f in enumerate(forms))
    return f"CASE ({number}) % 6 {cases} END"


FORMS = [
    (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "%Y-%m-%d"),
    (r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "%Y/%m/%d"),
    (r"[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", "%m-%d-%Y"),
    (r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%m/%d/%Y"),
    (r"[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日", "%Y年%m月%d日"),
    (r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}", "%d.%m.%Y"),
]


def literals(source: str, key: str) -> str:
    """Rows of (key, literal, day) from texts, form by form."""
    parts = [
        f"""SELECT {key}, literal, try_strptime(literal, '{fmt}')::DATE AS day FROM (
              SELECT {key}, unnest(regexp_extract_all(text, '(?:^|[^0-9])({pat})(?:$|[^0-9])', 1)) AS literal
              FROM {source})"""
        for pat, fmt in FORMS
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE day IS NOT NULL"


ORDER_TEXTS = f"""
  SELECT o_orderkey, concat('ordered ', {written('o_orderdate', 'o_orderkey')}, ' ; due ',
    {written("(o_orderdate::DATE + 30)", 'o_orderkey + 3')},
    ' ; never 1997-02-30 ; number 91997-03-04 ; total ',
    o_totalprice::DECIMAL(18,2)::VARCHAR, ' 元 .') AS text
  FROM orders"""


def ranges(source: str, key: str) -> str:
    return f"""
  WITH texts AS ({source}),
  lits AS ({literals('texts', key)}),
  agg AS (SELECT {key}, count(DISTINCT literal) AS n, min(day) AS lo, max(day) AS hi FROM lits GROUP BY {key}),
  keys AS (SELECT DISTINCT {key} FROM texts)
  SELECT {key}, coalesce(n, 0)::BIGINT AS n_literals,
    CASE WHEN n >= 2 THEN strftime(lo, '%Y-%m-%d') ELSE '' END AS start_date,
    CASE WHEN n >= 2 THEN strftime(hi, '%Y-%m-%d') ELSE '' END AS end_date,
    CASE WHEN n >= 2 THEN 'ok' ELSE 'too few dates' END AS status
  FROM keys LEFT JOIN agg USING ({key})"""


def text_double(x: str) -> str:
    return f"regexp_replace({x}::VARCHAR, '\\.0$', '')"


# A JSON map of the event properties, values as text.
PROP = "json_extract_string(props, '$.{}')"


def pieces(expr: str, source: str = "documents", extra: str = "") -> str:
    """Numbered parts of each document."""
    return f"""
  WITH parts AS (SELECT doc_id, {expr} AS p {extra} FROM {source})
  SELECT doc_id, i::INTEGER AS id, p[i] AS text
  FROM parts, unnest(range(1, len(p) + 1)) AS r(i)"""


def not_blank(items: str) -> str:
    return f"list_filter({items}, lambda x: regexp_matches(x, '{NONSP}'))"


def paragraphs(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"


def sentences(x: str) -> str:
    return not_blank(f"regexp_extract_all({x}, '[^。！？!?]*[。！？!?]|[^。！？!?]+')")


def clauses(x: str) -> str:
    return not_blank(f"regexp_extract_all({x}, '[^，,]*[，,]|[^，,]+')")


def cut(x: str, n: int) -> str:
    return (
        f"list_transform(range(0, ((length({x}) + {n - 1}) // {n})::BIGINT), lambda q: substr({x}, q * {n} + 1, {n}))"
    )


def clause_pieces(x: str, n: int) -> str:
    return f"flatten(list_transform({clauses(x)}, lambda c: CASE WHEN length(c) > {n} THEN {cut('c', n)} ELSE [c] END))"


def pack(items: str, n: int) -> str:
    """Greedy packing as a reduction over {closed, open} states."""
    states = f"list_transform({items}, lambda x: {{'o': []::VARCHAR[], 'c': x}})"
    folded = f"""list_reduce({states}, lambda a, b: CASE WHEN length(a.c) + length(b.c) <= {n}
      THEN {{'o': a.o, 'c': a.c || b.c}} ELSE {{'o': list_append(a.o, a.c), 'c': b.c}} END)"""
    return f"CASE WHEN len({items}) = 0 THEN []::VARCHAR[] ELSE list_append(({folded}).o, ({folded}).c) END"


def semantic_items(x: str, n: int) -> str:
    return f"""flatten(list_transform({sentences(x)}, lambda s:
      CASE WHEN length(s) > {n} THEN {clause_pieces('s', n)} ELSE [s] END))"""


def semantic(source: str, n: int) -> str:
    """(doc_id, par, chunks) for texts (doc_id, par, text)."""
    return f"""
  WITH src AS ({source}),
  items AS (SELECT doc_id, par, text, CASE WHEN length(text) <= {n} THEN [text] ELSE {semantic_items('text', n)} END AS it
            FROM src),
  packed AS (SELECT doc_id, par, CASE WHEN length(text) <= {n} THEN it ELSE {pack('it', n)} END AS p FROM items)"""


PARAGRAPH_ROWS = f"""SELECT doc_id, i AS par, ps[i] AS text
  FROM (SELECT doc_id, {paragraphs('text')} AS ps FROM documents), unnest(range(1, len(ps) + 1)) AS r(i)"""

N, S = Q.MAX_LEN, Q.SHORT_LEN

LONG_FIRST = f"""
  WITH s AS (SELECT doc_id, text, {sentences('text')} AS ss FROM documents),
  st AS (SELECT doc_id, text, list_prepend({{'o': []::VARCHAR[], 'c': '', 'n': ''}},
           list_transform(ss, lambda x: {{'o': []::VARCHAR[], 'c': '', 'n': x}})) AS items FROM s),
  folded AS (SELECT doc_id, text, list_reduce(items, lambda a, b: CASE
      WHEN length(b.n) > {S} THEN {{'o': list_concat(a.o, {clause_pieces('b.n', S)}), 'c': a.c, 'n': ''}}
      WHEN length(a.c) + length(b.n) <= {S} THEN {{'o': a.o, 'c': a.c || b.n, 'n': ''}}
      WHEN a.c = '' THEN {{'o': a.o, 'c': b.n, 'n': ''}}
      ELSE {{'o': list_append(a.o, a.c), 'c': b.n, 'n': ''}} END) AS f FROM st),
  parts AS (SELECT doc_id, CASE WHEN length(text) <= {S} THEN [text]
      WHEN f.c = '' THEN f.o ELSE list_append(f.o, f.c) END AS p FROM folded)
  SELECT doc_id, i::INTEGER AS id, p[i] AS text FROM parts, unnest(range(1, len(p) + 1)) AS r(i)"""

P = Q.MAX_LEN // 2
_PCUT = cut("b.n", P)
PACKED = f"""
  WITH st AS (SELECT doc_id, list_prepend({{'o': []::VARCHAR[], 'c': '', 'n': ''}},
           list_transform(string_split(text, chr(10)), lambda x: {{'o': []::VARCHAR[], 'c': '', 'n': x}})) AS items
         FROM documents),
  folded AS (SELECT doc_id, list_reduce(items, lambda a, b: CASE
      WHEN length(a.c) + length(b.n) + (CASE WHEN a.c = '' THEN 0 ELSE 2 END) <= {P}
        THEN {{'o': a.o, 'c': CASE WHEN a.c = '' THEN b.n ELSE concat(a.c, chr(10), chr(10), b.n) END, 'n': ''}}
      WHEN length(b.n) <= {P}
        THEN {{'o': CASE WHEN a.c = '' THEN a.o ELSE list_append(a.o, a.c) END, 'c': b.n, 'n': ''}}
      ELSE {{'o': list_concat(CASE WHEN a.c = '' THEN a.o ELSE list_append(a.o, a.c) END,
                list_slice({_PCUT}, 1, len({_PCUT}) - 1)), 'c': ({_PCUT})[-1], 'n': ''}} END) AS f FROM st),
  parts AS (SELECT doc_id, {not_blank("CASE WHEN f.c = '' THEN f.o ELSE list_append(f.o, f.c) END")} AS p FROM folded)
  SELECT doc_id, i::INTEGER AS id, p[i] AS text FROM parts, unnest(range(1, len(p) + 1)) AS r(i)"""

WINDOWS = f"""
  WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{SP}+'), lambda t: t <> '') AS t FROM documents),
  starts AS (SELECT doc_id, t, list_filter(range(0, len(t), 462), lambda i: i = 0 OR i + 50 < len(t)) AS s FROM w)
  SELECT doc_id, j::INTEGER AS id, array_to_string(list_slice(t, s[j] + 1, s[j] + 512), ' ') AS text
  FROM starts, unnest(range(1, len(s) + 1)) AS r(j)"""

SLICES = f"""{semantic("SELECT doc_id, 1 AS par, text FROM documents", N)}
  SELECT concat('docs/', doc_id, '.docx') AS source, {N}::INTEGER AS max_slice_length, len(p)::BIGINT AS slice_count,
    array_to_string(list_transform(range(1, len(p) + 1), lambda i: concat(i, ':', p[i])), '|') AS slices
  FROM packed"""

SHEET_ROWS = """
  SELECT c_mktsegment AS sheet, c_custkey AS row_idx, CASE WHEN c_nationkey = 3 THEN [NULL, NULL]
    WHEN c_nationkey = 5 THEN [NULL, c_acctbal::DECIMAL(18,2)::VARCHAR] WHEN c_nationkey = 7 THEN [c_name]
    ELSE [c_name, c_acctbal::DECIMAL(18,2)::VARCHAR, c_nationkey::VARCHAR] END AS cells FROM customer"""

MD_LINES = f"""
  WITH kept AS (SELECT * FROM ({SHEET_ROWS}) WHERE len(list_filter(cells, lambda c: c IS NOT NULL)) > 0),
  w AS (SELECT *, min(row_idx) OVER (PARTITION BY sheet) AS head, max(len(cells)) OVER (PARTITION BY sheet) AS width FROM kept),
  body AS (SELECT sheet, row_idx * 2 AS line_no, concat('| ', array_to_string(
      list_transform(range(1, width + 1), lambda i: coalesce(cells[i], '')), ' | '), ' |') AS line FROM w),
  rule AS (SELECT sheet, row_idx * 2 + 1 AS line_no, concat('|', repeat(' --- |', width::BIGINT)) AS line FROM w WHERE row_idx = head)
  SELECT * FROM body UNION ALL SELECT * FROM rule"""

MD_TABLES = """
  WITH place AS (SELECT l_orderkey AS sheet, l_partkey AS p, l_suppkey AS s, l_linenumber AS l,
      min({'a': l_returnflag, 'b': l_linenumber::VARCHAR, 'c': l_partkey::VARCHAR}) AS x FROM lineitem GROUP BY ALL),
  n AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY p, s, l) AS rn FROM place)
  SELECT sheet, (rn // 10000)::BIGINT AS part, string_agg(concat('| ', x.a, ' | ', x.b, ' | ', x.c, ' |',
      CASE WHEN rn = 1 THEN concat(chr(10), '| --- | --- | --- |') ELSE '' END), chr(10) ORDER BY rn) AS markdown
  FROM n GROUP BY sheet, part"""

NUMBER_UNITS = """
  SELECT c_custkey, CASE c_custkey % 6
    WHEN 3 THEN '0' WHEN 5 THEN ''
    ELSE regexp_replace(regexp_replace(((CASE WHEN c_custkey % 6 = 4 THEN -1 ELSE 1 END) * abs(c_acctbal)::DECIMAL(18,2)
      * (CASE c_custkey % 6 WHEN 0 THEN 10000 WHEN 1 THEN 1 WHEN 2 THEN 100000000 ELSE 1000000000000 END)::DECIMAL(13,0))::VARCHAR,
      '0+$', ''), '\\.$', '') END AS number
  FROM customer"""

_REGIONS = ", ".join(f"'{p}'" for p in [*CHINESE_PROVINCES[:30], "Ohio", " 湖北省 ", "江苏"])
_MEMBERS = ", ".join(f"'{p}'" for p in CHINESE_PROVINCES)
LOOKUP = f"""
  WITH r AS (SELECT c_custkey, ([{_REGIONS}])[(c_custkey % 33 + 1)::INTEGER] AS region,
    CASE WHEN c_nationkey = 4 THEN 'set' ELSE '' END AS continent FROM customer)
  SELECT c_custkey, region, CASE WHEN continent = '' AND trim(region) IN ({_MEMBERS}) THEN 'Asia' ELSE continent END AS continent
  FROM r"""

EVENT_PROSE_RECORDS = f"""
  SELECT event_id, event_type AS kind, regexp_replace(regexp_replace(
      (round(value, 2)::DECIMAL(18,2) * 10000)::VARCHAR, '0+$', ''), '\\.$', '') AS amount,
    strftime(ts, '%Y-%m-%d') AS day,
    CASE WHEN user_id % 2 = 0 THEN '湖北省' ELSE '' END AS region,
    CASE WHEN user_id % 2 = 0 THEN 'Asia' ELSE '' END AS continent
  FROM events"""

ENTITIES = f"""
  WITH texts AS ({ORDER_TEXTS}), lits AS ({literals('texts', 'o_orderkey')})
  SELECT o_orderkey, 'date' AS field, strftime(day, '%Y-%m-%d') AS value, literal AS raw, 'rule' AS tier FROM lits
  UNION ALL
  SELECT o_orderkey, 'amount', regexp_replace(regexp_replace(o_totalprice::DECIMAL(18,2)::VARCHAR, '0+$', ''), '\\.$', ''),
    concat(o_totalprice::DECIMAL(18,2)::VARCHAR, ' 元'), 'rule' FROM orders"""

POOL = f"""
  WITH rules AS ({ENTITIES}),
  pool AS (SELECT o_orderkey, field, value, 0.9::DOUBLE AS confidence, tier FROM rules
    UNION ALL SELECT o_orderkey, 'amount', o_totalprice::DECIMAL(18,1)::VARCHAR,
      (CASE WHEN o_orderpriority = '1-URGENT' THEN 0.95 ELSE 0.5 END)::DOUBLE, 'model' FROM orders
    UNION ALL SELECT o_orderkey, 'status', o_orderstatus, 0.7::DOUBLE, 'model' FROM orders)
  SELECT o_orderkey, field, value, confidence, tier, CASE WHEN confidence < 0.8 THEN 'review' ELSE 'ok' END AS review
  FROM pool QUALIFY row_number() OVER (PARTITION BY o_orderkey, field ORDER BY confidence DESC, value) = 1"""

# --- retrieval ---

TOKENS = f"list_filter(regexp_split_to_array(text, '{SP}+'), lambda t: t <> '')"
BM25_BASE = f"""
  toks AS MATERIALIZED (SELECT doc_id AS node_id, {TOKENS} AS t FROM documents),
  dl AS (SELECT node_id, len(t) AS dl FROM toks),
  post AS MATERIALIZED (SELECT node_id, term, count(*) AS tf FROM (SELECT node_id, unnest(t) AS term FROM toks) GROUP BY ALL),
  g AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
  dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
  raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM dfs, g),
  mi AS (SELECT avg(r) AS m FROM raw),
  idf AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * m ELSE r END AS idf FROM raw, mi)"""


def bm25_scores(queries: str) -> str:
    """CTEs ending in scores(query_id, node_id, score) for (query_id, text) queries."""
    return f"""{BM25_BASE},
  q AS ({queries}),
  qt AS (SELECT query_id, term, count(*) AS w FROM (SELECT query_id, unnest({TOKENS}) AS term FROM q) GROUP BY ALL),
  scores AS (SELECT query_id, node_id, sum(w * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
    FROM qt JOIN idf USING (term) JOIN post USING (term) JOIN dl USING (node_id), g GROUP BY query_id, node_id)"""


BENCH_Q = "SELECT item_id AS query_id, text FROM benchmark"
VEC_Q = "SELECT item_id AS query_id, embedding AS qe FROM benchmark JOIN embeddings ON vec_id = item_id"
COSINE = "round(list_cosine_similarity(qe::DOUBLE[], embedding::DOUBLE[]), 6)"
CENTROIDS = """
  SELECT query_id, list(x ORDER BY i) AS qe FROM (
    SELECT label::BIGINT AS query_id, i, avg(embedding[i]::DOUBLE) AS x
    FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(i) GROUP BY label, i) GROUP BY query_id"""


def ranked(source: str, k: int | None) -> str:
    cap = f"QUALIFY rank <= {k}" if k else ""
    return f"""SELECT query_id, node_id, score, row_number() OVER (
      PARTITION BY query_id ORDER BY score DESC, node_id) AS rank FROM ({source}) {cap}"""


def hybrid(k: int | None) -> str:
    # The pairing of texts with vectors keeps queries that have both.
    both = "SELECT item_id AS query_id, text FROM benchmark WHERE item_id IN (SELECT vec_id FROM embeddings)"
    return f"""
  WITH {bm25_scores(both)},
  b AS ({ranked("SELECT query_id, node_id, round(score, 6) AS score FROM scores", k)}),
  vq AS ({VEC_Q}),
  v AS ({ranked(f"SELECT query_id, vec_id AS node_id, {COSINE} AS score FROM vq, embeddings", k)}),
  f AS (SELECT query_id, node_id, round(sum(1.0::DOUBLE / (60 + rank - 1)), 9) AS score
        FROM (SELECT query_id, node_id, rank FROM b UNION ALL SELECT query_id, node_id, rank FROM v) GROUP BY ALL)
  SELECT query_id, node_id, score, rank::INTEGER AS rank FROM ({ranked("SELECT * FROM f", 5)})"""


def _prompt_head() -> str:
    """The fixed part of the request text, as a SQL literal."""
    text = (
        "Read the text and give one flat JSON object with exactly these keys:\n- amount\n- date\n"
        "One main subject only; an unknown value is an empty string.\n"
        "Numbers: digits only, no unit, no thousands comma, 万 and 亿 multiplied out.\n"
        "The words 全零报告, 无新增, 零新增 make a count 0.\n"
        "国家/地区: the region's name without bold marks. 大洲: Asia for a region of China.\n"
        "Text:\n"
    )
    return "'" + text.replace("'", "''") + "'"


# White space and tokens of sentence windows, as in functions/chunks.py.
GAP = r"[\t\n\x0B\f\r ]"
TOKEN = r"(?:[\x{4E00}-\x{9FFF}]|[^\t\n\x0B\f\r \x{4E00}-\x{9FFF}]+)"


def sentence_windows(source: str) -> str:
    """CTEs ending in windows(doc_id, id, text); a window is found from running token counts."""
    mark = "chr(57344)"
    split = (
        rf"regexp_replace(regexp_replace(text, '([。！？!?\n])', '\1' || {mark}, 'g'), '\.({GAP})', '.' || {mark} || '\1', 'g')"
    )
    count = f"len(regexp_extract_all(s, '{TOKEN}'))"
    return f"""
  src AS ({source}),
  pieces AS (SELECT doc_id, list_filter(string_split({split}, {mark}), lambda s: s <> '') AS p FROM src),
  parts AS (SELECT doc_id, flatten(list_transform(p, lambda s: CASE WHEN {count} > {Q.WINDOW}
      THEN regexp_extract_all(s, '{GAP}*(?:{TOKEN}{GAP}*){{1,{Q.WINDOW}}}') ELSE [s] END)) AS s FROM pieces),
  counted AS (SELECT doc_id, s, list_transform(s, lambda s: {count}) AS c FROM parts),
  summed AS MATERIALIZED (SELECT doc_id, s, c, list_transform(range(1, len(c) + 1), lambda i: list_sum(list_slice(c, 1, i))::BIGINT) AS cum FROM counted WHERE len(c) > 0),
  spans(doc_id, a, b) AS (
    SELECT doc_id, 1::BIGINT, len(list_filter(cum, lambda x: x <= {Q.WINDOW}))::BIGINT FROM summed
    UNION ALL
    SELECT doc_id, j, len(list_filter(cum, lambda x: x - cum[j - 1] <= {Q.WINDOW}))::BIGINT
    FROM (SELECT doc_id, cum, list_filter(range(a + 1, b + 2), lambda j: cum[b] - cum[j - 1] <= least({Q.CARRIED}, {Q.WINDOW} - c[b + 1]))[1] AS j
      FROM spans JOIN summed USING (doc_id) WHERE b < len(c))),
  cut AS (SELECT doc_id, a, array_to_string(list_slice(s, a, b), '') AS text FROM spans JOIN summed USING (doc_id)),
  windows AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS id, text FROM cut WHERE regexp_matches(text, '{NONSP}'))"""


# Ids are paths: compared as text, the name of a document's only file is the same in all its ids.
FOLDER_DOCS = "SELECT doc_id, concat(text, chr(10)) AS text FROM documents"
LETTERS = "[" + ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE" for c in "aeinorst") + "]"
FOLDER_SEARCH = f"""
  WITH RECURSIVE {sentence_windows(FOLDER_DOCS)},
  nodes AS MATERIALIZED (SELECT concat(doc_id, '/#', id) AS doc_id, doc_id AS doc, id AS chunk, text FROM windows),
  {bm25_scores(BENCH_Q).replace("FROM documents", "FROM nodes")},
  vec AS (SELECT doc_id AS node_id, {LETTERS} AS embedding FROM nodes),
  vq AS (SELECT item_id AS query_id, {LETTERS} AS qe FROM benchmark),
  near AS MATERIALIZED (SELECT query_id, node_id, {COSINE} AS score FROM vq, vec
    WHERE list_sum(qe) > 0 AND list_sum(embedding) > 0),
  b AS ({ranked("SELECT query_id, node_id, round(score, 6) AS score FROM scores", 5)}),
  v AS ({ranked("SELECT * FROM near", 5)}),
  f AS (SELECT query_id, node_id, sum(1.0::DOUBLE / (60 + rank - 1)) AS score
    FROM (SELECT query_id, node_id, rank FROM b UNION ALL SELECT query_id, node_id, rank FROM v) GROUP BY ALL),
  hits AS (
    SELECT 'bm25' AS mode, query_id, node_id, score FROM scores WHERE score >= {Q.FOLDER_THRESHOLDS["bm25"]}
    UNION ALL SELECT 'vector', query_id, node_id, score FROM near WHERE score >= {Q.FOLDER_THRESHOLDS["vector"]}
    UNION ALL SELECT 'hybrid', query_id, node_id, score FROM f)
  SELECT mode, query_id, doc AS doc_id, chunk, round(score, 4) AS score, text FROM hits JOIN nodes ON node_id = nodes.doc_id"""

ODD_VECTORS = """
  odd AS (SELECT vec_id, CASE vec_id % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'length' WHEN 3 THEN 'zero' WHEN 4 THEN 'incomplete' END AS reason,
    embedding AS v, list_slice(embedding, 1, 32) AS half FROM embeddings)"""

REPLIES = """
  SELECT event_id, CASE event_id % 7
    WHEN 1 THEN json_extract_string(props, '$.k') WHEN 2 THEN json_extract_string(props, '$.k')
    WHEN 6 THEN '' END AS k,
    CASE WHEN event_id % 7 = 6 THEN user_id::VARCHAR ELSE '' END AS x
  FROM events WHERE event_id % 7 IN (1, 2, 6)"""

TEMPLATE_FILL = f"""
  WITH recs AS (
    SELECT 0 AS branch, o_orderkey AS key, o_orderkey::VARCHAR AS o_orderkey,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, {text_double('o_totalprice')} AS o_totalprice,
      NULL AS kind, NULL AS amount
    FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'
    UNION ALL
    SELECT 1, event_id, '', '', '', kind, amount FROM ({EVENT_PROSE_RECORDS})),
  r AS (SELECT *, row_number() OVER (ORDER BY branch, key) AS pos FROM recs),
  t AS (SELECT row_number() OVER (ORDER BY p_partkey) AS pos, p_name, p_brand, p_type FROM part)
  SELECT pos, coalesce(o_orderkey, p_type, '') AS o_orderkey, coalesce(o_orderdate, '') AS o_orderdate,
    coalesce(o_totalprice, '') AS o_totalprice, coalesce(kind, p_name, '') AS kind, coalesce(amount, p_brand, '') AS amount
  FROM r FULL JOIN t USING (pos)"""

BOOK_PRICE = "regexp_replace(o_totalprice::VARCHAR, '\\.0$', '')"
BOOK_ROWS = f"""
  SELECT concat('books/', o_orderkey, '.xlsx') AS path, 'data' AS sheet, 0::INTEGER AS sheet_idx, 1::INTEGER AS row_idx,
    concat(o_orderkey, '|', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '|', o_orderstatus, '|', {BOOK_PRICE}) AS cells, o_orderdate AS d
  FROM orders UNION ALL
  SELECT concat('books/', o_orderkey, '.xlsx'), 'data', 0, 3,
    concat(o_orderkey, '|', strftime(o_orderdate + INTERVAL 400 DAY, '%Y-%m-%d %H:%M:%S'), '||7'), o_orderdate + INTERVAL 400 DAY
  FROM orders UNION ALL
  SELECT concat('books/', o_orderkey, '.xlsx'), 'notes', 1, 1, 'none', NULL FROM orders"""

DOCX_BLOCKS = f"""
  WITH b AS (SELECT doc_id, list_concat({paragraphs("regexp_replace(text, '[" + r"\x00-\x08\x0b\x0c\x0e-\x1f" + "]', '', 'g')")},
      [lang, lang, lang, 'end']) AS t FROM documents),
  r AS (SELECT concat('docs/', doc_id, '.docx') AS path, i - 1 AS pos, t[i] AS text, len(t) AS n, i
    FROM b, unnest(range(1, len(t) + 1)) AS r(i))"""

CUSTOMER_FILES = "SELECT c_nationkey::BIGINT AS k, string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10) AS t, min_by(c_name, c_custkey) AS top FROM customer GROUP BY c_nationkey"
HAN_DIGITS = "'0123456789', '零一二三四五六七八九'"
HAN_PAIRS = "list_transform(range(1, greatest(length(text) - 1, 1) + 1), lambda i: substr(text, i, 2))"

ORACLES = {
    "folder_texts": f"SELECT k AS nation, t AS text, 'done' AS status FROM ({CUSTOMER_FILES})",
    "folder_markdown": """SELECT concat(n_nationkey, '.md') AS file,
    CASE WHEN n_nationkey % 3 = 0 THEN concat('# é ', n_name) ELSE concat('# 国家 ', n_name) END AS text, 'done' AS status FROM nation""",
    "json_objects": """SELECT c_custkey::VARCHAR AS key, c_name AS name, NULL::BIGINT AS n FROM customer
  UNION ALL SELECT NULL, c_mktsegment, count(*) FROM customer GROUP BY c_mktsegment""",
    "json_lists": """
  WITH l AS (SELECT n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos, n_name AS name,
    CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey::VARCHAR END AS odd FROM nation)
  SELECT concat(r, '.json') AS file, pos::INTEGER AS pos, name, odd FROM l WHERE r <> 2
  UNION ALL SELECT 'table', 0, name, odd FROM l WHERE r = 1""",
    "json_template": """SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, 'o_orderstatus|zz|o_orderkey' AS fields
  FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-05-31'""",
    "template_rows": """SELECT row_number() OVER (ORDER BY n_nationkey) AS pos, n_name AS name, n_regionkey::VARCHAR AS region, 'none' AS again,
  'name||region|name' AS header, 2::BIGINT AS n_sheets FROM nation""",
    "stored_tables": """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, f AS file FROM customer,
    (VALUES ('data_filtered.csv'), ('data_filtered.parquet')) AS v(f)
  UNION ALL SELECT n_nationkey, n_name, 'one', 'nation.json' FROM nation""",
    "converted_files": f"""
  WITH f AS ({CUSTOMER_FILES}),
  a AS (SELECT k, CASE WHEN k % 3 = 0 THEN 'skipped' WHEN k = 1 THEN 'failed' ELSE 'done' END AS status, top FROM f)
  SELECT k AS nation, 'stored' AS status, '' AS message, concat('```text', chr(10), t, chr(10), '```') AS markdown FROM f WHERE k % 3 = 0
  UNION ALL SELECT k, 'stored', '', top FROM a WHERE status = 'done'
  UNION ALL SELECT k, status, CASE status WHEN 'skipped' THEN 'already converted' WHEN 'failed' THEN 'ValueError: not this one' ELSE '' END,
    CASE WHEN status = 'done' THEN top END FROM a""",
    "observed_run": """WITH m AS (SELECT doc_id IN (SELECT doc_id FROM labels) AS s FROM documents)
  SELECT count(*) AS total, count(*) AS success, 0::BIGINT AS failed, count(*) FILTER (s) AS skipped, source
  FROM m, (VALUES ('observed'), ('aggregate')) AS v(source) GROUP BY source""",
    "date_column_chosen": """SELECT o_orderkey::VARCHAR AS k, CASE WHEN o_orderkey % 16 > 0 THEN strftime(o_orderdate, '%Y/%-m/%-d') ELSE '?' END AS day,
  'most' AS chosen, 'none' AS without FROM orders""",
    "han_index": f"""
  WITH documents AS (SELECT o_orderkey AS doc_id, translate(o_orderkey::VARCHAR, {HAN_DIGITS}) AS text FROM orders),
  {bm25_scores(f"SELECT n_nationkey AS query_id, translate((n_nationkey * 37 + 10)::VARCHAR, {HAN_DIGITS}) AS text FROM nation").replace(TOKENS, HAN_PAIRS)}
  SELECT query_id, node_id, score, rank::INTEGER AS rank
  FROM ({ranked("SELECT query_id, node_id, round(score, 4) AS score FROM scores", 5)})""",
    "pooled_fields": """SELECT o_orderkey, '合同金额' AS template_field, 'amount' AS field,
  CASE WHEN o_orderkey % 4 = 0 THEN 'model says' ELSE (o_orderkey * 10000)::VARCHAR END AS value,
  CASE WHEN o_orderkey % 4 = 0 THEN 'model' ELSE 'rule' END AS tier FROM orders""",
    "stored_index": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, node_id, score, rank::INTEGER AS rank
  FROM ({ranked("SELECT query_id, node_id, round(score, 4) AS score FROM scores", 5)})""",
    "retrieval_chunks": f"""
  WITH w AS (SELECT doc_id, {TOKENS} AS t FROM documents),
  starts AS (SELECT doc_id, t, list_filter(range(0, len(t), 56), lambda i: i = 0 OR i + 8 < len(t)) AS s FROM w),
  documents AS (SELECT doc_id * 100000 + j AS doc_id, array_to_string(list_slice(t, s[j] + 1, s[j] + 64), ' ') AS text
    FROM starts, unnest(range(1, len(s) + 1)) AS r(j)),
  {bm25_scores(f"SELECT 0 AS query_id, '{Q.ONE_QUERY}' AS text")}
  SELECT node_id, round(coalesce(score, 0.0), 4) AS score FROM dl LEFT JOIN scores USING (node_id)""",
    "workbook_cells": f"""SELECT path, sheet, sheet_idx, row_idx,
    CASE WHEN sheet = 'data' THEN '订单|UpdateTime|Unnamed: 2|价格' ELSE 'empty' END AS header, cells FROM ({BOOK_ROWS})""",
    "workbook_columns": f"""SELECT concat('books/', o_orderkey, '.xlsx') AS path, r::INTEGER AS row_idx, o_orderkey::VARCHAR AS key,
    CASE WHEN r = 1 THEN {BOOK_PRICE} ELSE '7' END AS price FROM orders, (VALUES (1), (3)) AS v(r)""",
    "workbook_markdown": """
  WITH o AS (SELECT strftime(o_orderdate, '%Y') AS path, o_orderstatus AS s, o_orderkey AS k,
      concat('| ', o_orderkey, ' | ', CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '' END, ' |') AS line FROM orders),
  l AS (SELECT *, k = min(k) OVER (PARTITION BY path, s) AS top, k // 100 AS part FROM o),
  p AS (SELECT path, s, part, bool_or(top) AS top,
      string_agg(CASE WHEN top THEN concat(line, chr(10), '| --- | --- |') ELSE line END, chr(10) ORDER BY k) AS t FROM l GROUP BY ALL),
  e AS (SELECT *, part = max(part) OVER (PARTITION BY path, s) AS last FROM p)
  SELECT path, concat('s', s) AS sheet, ascii(s)::INTEGER AS sheet_idx, part::BIGINT AS part,
    concat(CASE WHEN top THEN concat('<!-- 工作表: s', s, ' -->', chr(10), chr(10)) ELSE '' END, t, CASE WHEN last THEN chr(10) || chr(10) ELSE '' END) AS markdown FROM e
  UNION ALL SELECT DISTINCT path, 'none', 1, 0, concat('<!-- 工作表: none -->', chr(10), '*(工作表无数据)*', chr(10)) FROM o""",
    "workbook_range": f"""SELECT path, sheet, row_idx, cells FROM ({BOOK_ROWS})
  WHERE d IS NULL OR d BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'""",
    "docx_blocks": f"""{DOCX_BLOCKS}
  SELECT path, CASE WHEN i <= n - 4 THEN 'body' WHEN i <= n - 2 THEN 'table' WHEN i = n - 1 THEN 'header' ELSE 'footer' END AS block_kind,
    pos::INTEGER AS pos, text FROM r""",
    "docx_slices": f"""{DOCX_BLOCKS}, {semantic("SELECT path AS doc_id, i AS par, text FROM r", S).strip().removeprefix("WITH")},
  f AS (SELECT doc_id, flatten(list(p ORDER BY par)) AS c FROM packed GROUP BY doc_id)
  SELECT doc_id AS source, len(c)::BIGINT AS slice_count,
    array_to_string(list_transform(range(1, len(c) + 1), lambda i: concat(i, ':', c[i])), '|') AS slices FROM f""",
    "decoded_texts": r"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text
    ELSE regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g') END AS text FROM documents""",
    "stored_records": f"""SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_nationkey = 3 THEN 'null'
    ELSE {text_double('c_acctbal')} END AS balance, c_mktsegment AS source_file FROM customer""",
    "template_fill": TEMPLATE_FILL,
    "date_literals": f"""WITH texts AS ({ORDER_TEXTS})
  SELECT o_orderkey, literal, strftime(day, '%Y-%m-%d') AS day FROM ({literals('texts', 'o_orderkey')})""",
    "request_ranges": ranges(ORDER_TEXTS, "o_orderkey"),
    "doc_date_range": ranges(
        f"""SELECT l_orderkey AS doc, concat('shipped ', {written('l_shipdate', 'l_linenumber')}) AS text FROM lineitem
      UNION ALL SELECT o_orderkey, concat('ordered ', {written('o_orderdate', 'o_orderkey')}) FROM orders""",
        "doc",
    ),
    "range_filter_orders": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
  WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'""",
    "range_filter_events": """SELECT event_id, event_type, value FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""",
    "range_filter_text_dates": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
  WHERE o_orderdate::DATE BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""",
    "date_column_ratio": """
  WITH s AS (SELECT * FROM events ORDER BY event_id LIMIT 100),
  u AS (SELECT 'event_id' AS column_name, event_id::VARCHAR AS v FROM s UNION ALL SELECT 'ts', ts::VARCHAR FROM s
    UNION ALL SELECT 'user_id', user_id::VARCHAR FROM s UNION ALL SELECT 'event_type', event_type FROM s
    UNION ALL SELECT 'value', value::VARCHAR FROM s UNION ALL SELECT 'props', props FROM s)
  SELECT column_name, avg(CASE WHEN coalesce(try_cast(v AS TIMESTAMP), try_strptime(v, '%Y%m%d'),
      CASE WHEN regexp_matches(v, '^[0-9]{4}$') THEN try_strptime(v, '%Y') END)
    BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' AND TIMESTAMP '2262-04-11 23:47:16.854775' THEN 1.0 ELSE 0.0 END)::DOUBLE AS ratio
  FROM u GROUP BY column_name""",
    "template_project": f"""SELECT o_orderkey::VARCHAR AS o_orderkey, {text_double('o_totalprice')} AS o_totalprice,
  o_orderpriority FROM orders""",
    "template_missing": """SELECT event_id, CASE WHEN json_contains(json_keys(props)::JSON, '"k"') THEN 'k' ELSE '' END AS present,
  array_to_string(list_filter(['zz', 'k', 'unit'], lambda f: NOT list_contains(json_keys(props), f)), '|') AS missing FROM events""",
    "conform_records": f"SELECT event_id, {PROP.format('k')} AS k, '' AS zz FROM events",
    "all_string_records": f"""SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
  {text_double('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer""",
    "merge_records": """SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_mktsegment AS segment, '' AS nation FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_name, '', s_nationkey::VARCHAR FROM supplier""",
    "overlay_fill": """
  WITH t AS (SELECT row_number() OVER (ORDER BY p_partkey) AS pos, * FROM part),
  r AS (SELECT row_number() OVER (ORDER BY c_custkey) AS pos, CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END AS n, * FROM customer)
  SELECT pos, coalesce(n, p_name, '') AS name, coalesce(c_mktsegment, '') AS segment, coalesce(p_brand, '') AS note,
    coalesce(n, '') AS name_1, coalesce(p_size::VARCHAR, '') AS size
  FROM r FULL JOIN t USING (pos)""",
    "multi_template_fill": f"""
  SELECT p_partkey::VARCHAR AS p_partkey, 'prices' AS template, 1 AS field_no, 'p_name' AS field, p_name AS value FROM part
  UNION ALL SELECT p_partkey::VARCHAR, 'prices', 2, 'p_retailprice', {text_double('p_retailprice')} FROM part
  UNION ALL SELECT p_partkey::VARCHAR, 'brands', 1, 'p_brand', p_brand FROM part
  UNION ALL SELECT p_partkey::VARCHAR, 'brands', 2, 'p_type', p_type FROM part
  UNION ALL SELECT p_partkey::VARCHAR, 'sizes', 1, 'p_size', p_size::VARCHAR FROM part
  UNION ALL SELECT p_partkey::VARCHAR, 'sizes', 2, 'p_name', p_name FROM part""",
    "fill_many_in_place": """
  WITH r AS (SELECT row_number() OVER (ORDER BY p_partkey) AS pos, CASE WHEN p_size <> 7 THEN p_name END AS name, p_brand AS brand,
    CASE WHEN p_size = 9 THEN '' ELSE p_type END AS type FROM part),
  o AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderstatus AS a, o_orderpriority AS c FROM orders),
  s AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS pos, s_name AS a FROM supplier)
  SELECT 'orders' AS template, pos, concat(coalesce(type, a), '|', name, '|', coalesce(name, c)) AS cells FROM r FULL JOIN o USING (pos)
  UNION ALL SELECT 'suppliers', pos, CASE WHEN a IS NULL THEN concat('||', brand) ELSE concat(a, '|x|', brand, '|last') END
  FROM r FULL JOIN s USING (pos)
  UNION ALL SELECT 'empty', pos, brand FROM r""",
    "job_report": """
  WITH n AS (SELECT n_nationkey AS k FROM nation),
  b AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'broken' WHEN k % 5 = 1 THEN 'other' ELSE 'good' END AS form FROM n)
  SELECT concat('book', k, '.xlsx') AS file, 'table' AS kind, CASE WHEN form = 'broken' THEN 'failed' ELSE 'done' END AS status,
    form = 'broken' AS told, (CASE form WHEN 'broken' THEN 0 WHEN 'other' THEN 1 ELSE 1 + k % 3 END)::BIGINT AS n_read,
    (CASE WHEN form = 'good' THEN CASE WHEN k % 3 = 2 THEN 2 ELSE 1 END ELSE 0 END)::BIGINT AS n_records FROM b
  UNION ALL SELECT concat('bad', k, '.txt'), 'prose', 'failed', true, 0, 0 FROM n WHERE k % 10 = 3
  UNION ALL SELECT DISTINCT concat('c_nationkey=', c_nationkey), 'prose', 'done', false, 2, 1 FROM customer""",
    "empty_templates": """SELECT c_custkey, concat('{"', c_name, '":"","', c_mktsegment, '":""}') AS template FROM customer""",
    "numbered_records": """SELECT row_no, concat('{"', row_no, '": {"c_custkey":"', c_custkey, '","c_name":"', c_name,
  '","c_mktsegment":"', c_mktsegment, '"}}') AS record
  FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_no, * FROM customer)""",
    "first_occurrences": """SELECT user_id, event_type, event_id, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "path_union": "SELECT DISTINCT url FROM pages WHERE contains(url, 'example') OR contains(url, 'https') OR contains(url, '/en/')",
    "paragraph_split": pieces(paragraphs("text")),
    "sentence_split": pieces(sentences("text")),
    "clause_split": pieces(clauses("text")),
    "hard_cut": pieces(cut("text", 500)),
    "semantic_chunks": f"""{semantic(PARAGRAPH_ROWS, N)},
  flat AS (SELECT doc_id, par, i, p[i] AS text FROM packed, unnest(range(1, len(p) + 1)) AS r(i))
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id, par, i) AS id FROM flat""",
    "semantic_chunks_short": f"""{semantic("SELECT doc_id, 1 AS par, text FROM documents", S)}
  SELECT doc_id, i::INTEGER AS id, p[i] AS text FROM packed, unnest(range(1, len(p) + 1)) AS r(i)""",
    "semantic_chunks_long_first": LONG_FIRST,
    "packed_paragraphs": PACKED,
    "token_windows": WINDOWS,
    "slice_documents": SLICES,
    "fenced_text": """SELECT doc_id, concat('```text', chr(10), text, chr(10), '```') AS markdown, substr(text, 1, 100) AS preview
  FROM documents""",
    "clean_text": f"""SELECT page_id, {strip(
        "regexp_replace(regexp_replace(regexp_replace(html, '[" + r"\x00-\x08\x0e-\x1f\x7f\x{FFFD}\x{FEFF}" + "]', '', 'g'), '["
        + r" \t\x{a0}\x{3000}" + "]+', ' ', 'g'), ' ?" + r"\r?\n" + " ?', chr(10), 'g')")} AS html FROM pages""",
    "path_parts": r"""
  WITH p AS (SELECT page_id, concat(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '.Html') AS path FROM pages)
  SELECT page_id, string_split(path, '/')[-1] AS name, regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', '') AS stem,
    '.html' AS suffix, concat(regexp_replace(path, '\.[^./]*$', ''), '.md') AS output FROM p""",
    "markdown_lines": MD_LINES,
    "markdown_tables": MD_TABLES,
    "number_units": NUMBER_UNITS,
    "mail_merge": """SELECT c_custkey, concat('Dear ', c_name, ' $1 \\,', chr(10), c_acctbal::DECIMAL(18,2)::VARCHAR, ' is due. ',
  c_name, ' $1 \\ / {{ unknown }} / ', CASE WHEN c_nationkey <> 3 THEN c_mktsegment ELSE '' END) AS letter FROM customer""",
    "mail_merge_nested": "SELECT c_custkey, concat('A {{ b }}', c_custkey, ' B ', c_name, '{{c}}') AS letter FROM customer",
    "long_numbers": """SELECT o_orderkey, concat('110101', lpad(o_orderkey::VARCHAR, 12, '0')) AS id_number,
  concat('0.', lpad(o_orderkey::VARCHAR, 12, '0'), '1') AS decimals,
  concat('9', lpad(o_orderkey::VARCHAR, 12, '0'), '500000000000') AS scaled FROM orders""",
    "distant_numbers": """SELECT o_orderkey, (o_orderkey * 10000)::VARCHAR AS amount, concat('00', o_orderkey) AS code,
  o_custkey::VARCHAR AS gdp FROM orders""",
    "first_filled_values": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 3 THEN c_mktsegment ELSE '?' END AS value
  FROM customer""",
    "blank_line_paragraphs": pieces(paragraphs("text")),
    "han_bigrams": """WITH h AS (SELECT o_orderkey, o_orderstatus, translate(o_orderkey::VARCHAR, '0123456789', '零一二三四五六七八九') AS han FROM orders),
  b AS (SELECT *, array_to_string(list_transform(range(1, greatest(length(han) - 1, 1) + 1), lambda i: substr(han, i, 2)), '|') AS pairs FROM h)
  SELECT o_orderkey, concat(pairs, '|', o_orderstatus, '|', pairs, '|元') AS tokens FROM b""",
    "bm25_topk_large": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, node_id, score, rank::INTEGER AS rank
  FROM ({ranked("SELECT query_id, node_id, round(score, 4) AS score FROM scores", 1500)})""",
    "lookup_default": LOOKUP,
    "lookup_default_table": """SELECT c_custkey, n_name AS nation, CASE WHEN c_custkey % 5 = 0 THEN 'kept'
  WHEN n_regionkey = 2 THEN 'ASIA' ELSE '' END AS area FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "reply_parse": REPLIES,
    "lenient_json": """SELECT event_id, event_type AS text, event_id::VARCHAR AS id FROM events WHERE event_id % 5 IN (0, 1, 2)""",
    "extraction_prompts": f"SELECT doc_id, concat({_prompt_head()}, text) AS prompt FROM documents",
    "rule_records": EVENT_PROSE_RECORDS,
    "rule_entities": ENTITIES,
    "entity_pool": POOL,
    "bm25_stats": f"""
  WITH held AS (SELECT DISTINCT doc_id, unnest({TOKENS}) AS term FROM documents),
  totals AS (SELECT term, count(*) AS df FROM held GROUP BY term),
  raw AS (SELECT term, df, ln((SELECT count(*) FROM documents) - df + 0.5) - ln(df + 0.5) AS r FROM totals)
  SELECT term, df AS n_nodes, round(CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END, 6) AS idf FROM raw""",
    "bm25_topk": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, node_id, score, rank::INTEGER AS rank
  FROM ({ranked("SELECT query_id, node_id, round(score, 4) AS score FROM scores", 5)})""",
    "bm25_all": f"""WITH {bm25_scores(f"SELECT 0 AS query_id, '{Q.ONE_QUERY}' AS text")}
  SELECT node_id, round(coalesce(score, 0.0), 4) AS score FROM dl LEFT JOIN scores USING (node_id)""",
    "bm25_threshold": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, node_id, round(score, 4) AS score FROM scores WHERE score >= {Q.BM25_THRESHOLD}""",
    "vector_topk": f"""WITH vq AS ({VEC_Q})
  SELECT query_id, node_id, score, rank::INTEGER AS rank
  FROM ({ranked(f"SELECT query_id, vec_id AS node_id, {COSINE} AS score FROM vq, embeddings", 5)})""",
    "vector_threshold": f"""WITH vq AS ({CENTROIDS})
  SELECT query_id, vec_id AS node_id, {COSINE} AS score FROM vq, embeddings WHERE {COSINE} >= {Q.VECTOR_THRESHOLD}""",
    "field_match": f"""WITH vq AS ({CENTROIDS})
  SELECT query_id, node_id, score FROM ({ranked(f"SELECT query_id, vec_id AS node_id, {COSINE} AS score FROM vq, embeddings", 1)})
  WHERE score >= 0.2""",
    "hybrid_rrf": hybrid(5),
    "hybrid_rrf_all": hybrid(None),
    "evidence": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, rank::INTEGER AS rank, node_id, score, lang, source, substr(d.text, 1, 100) AS preview
  FROM ({ranked("SELECT query_id, node_id, round(score, 4) AS score FROM scores", 5)}) JOIN documents d ON doc_id = node_id""",
    "evidence_hybrid": f"""SELECT query_id, rank, node_id, score, lang, substr(d.text, 1, 100) AS preview
  FROM ({hybrid(5)}) JOIN documents d ON doc_id = node_id""",
    "vector_text_ids": f"""WITH {ODD_VECTORS},
  n AS (SELECT concat('v#', vec_id) AS node_id, CASE WHEN reason = 'length' THEN half ELSE v END AS embedding, vec_id
    FROM odd WHERE reason IS NULL OR reason = 'length'),
  vq AS (SELECT node_id AS query_id, embedding AS qe FROM n WHERE vec_id % 5 = 0)
  SELECT query_id, node_id, score, rank::INTEGER AS rank FROM ({ranked(f"SELECT query_id, node_id, {COSINE} AS score FROM vq, n WHERE len(qe) = len(embedding)", 5)})""",
    "vector_left_out": f"WITH {ODD_VECTORS} SELECT reason, count(*) AS n FROM odd WHERE reason IS NOT NULL GROUP BY reason",
    "sentence_nodes": f"""WITH RECURSIVE {sentence_windows("""SELECT doc_id,
    concat(text, chr(10), translate(repeat(doc_id::VARCHAR, 25), '0123456789', '零一二三。五六七八九')) AS text FROM documents""")}
  SELECT doc_id, id::INTEGER AS id, text FROM windows""",
    "folder_search": FOLDER_SEARCH,
    "hit_counts": f"""WITH {bm25_scores(BENCH_Q)}
  SELECT query_id, least(count(*), 10) AS n_shown, greatest(count(*) - 10, 0) AS n_more FROM scores GROUP BY query_id""",
    "skip_existing": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "run_stats": """WITH m AS (SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skipped'
    WHEN lang = 'fr' THEN 'failed' ELSE 'done' END AS s FROM documents)
  SELECT count(*) AS total, count(*) FILTER (s <> 'failed') AS success, count(*) FILTER (s = 'failed') AS failed,
    count(*) FILTER (s = 'skipped') AS skipped FROM m""",
}

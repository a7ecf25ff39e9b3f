import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formweave.functions.text import words_and_bigrams
from formweave.operators import bm25, fusion, markdown, pool, positions, status, template, vector
from formweave.operators.chunking import document_chunks, numbered_chunks, retrieval_nodes, sentence_nodes
from formweave.operators.daterange import (
    date_column_by_content,
    filter_by_range,
    find_date_column,
    ranges_of_documents,
    ranges_of_lines,
    require_range,
)
from formweave.operators.extract import (
    default_from_list,
    default_from_table,
    extract_records,
    from_replies,
    instruction,
    rule_extractor,
)
from formweave.plans.pool import pooled_values
from formweave.session import copies, drop_copies, materialise
from formweave.sinks.tables import indexed_records


def plan(df):
    return df._jdf.queryExecution().toString()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- positions -------------------------------------------------------------


def test_positions_are_gapless_with_a_hot_key(spark):
    """A third of the rows share one key: order still decides each position."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id"),
    )
    got = rows(positions.global_position(df, ["k", "id"]), "pos")
    assert [r[2] for r in got] == list(range(1, 3001))
    assert [r[:2] for r in got] == sorted(r[:2] for r in got)


def test_positions_of_no_rows(spark):
    assert positions.global_position(spark.range(0), ["id"]).count() == 0


def test_global_rank_equals_row_number(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("g"), F.hash("id").alias("h"), "id")
    df = df.withColumn("g", F.when(F.col("id") < 900, 0).otherwise(F.col("g")))
    ranked = rows(positions.global_rank(df, ["g"], ["h", "id"]), "g", "h", "id")
    seen = Counter()
    for g, _, _, rank in ranked:
        seen[g] += 1
        assert rank == seen[g]


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("q"), F.col("id"))
    best = positions.top_k(df, ["q"], [F.desc("id")], 3)
    assert [r.id for r in best.filter("q = 1").orderBy("rank").collect()] == [999, 997, 995]
    assert "WindowGroupLimit" in plan(best) and "Partial" in plan(best)
    large = positions.top_k(spark.range(5000).withColumn("q", F.col("id") % 2), ["q"], [F.desc("id")], 2000)
    assert large.count() == 4000 and "WindowGroupLimit" in plan(large)


def test_first_occurrence(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, None)], "k string, n int, v string")
    assert rows(positions.first_occurrence(df, ["k"], ["n"]), "k") == [("a", 1, "x"), ("b", 3, None)]


def test_copies_stay_until_dropped(spark):
    drop_copies(spark)
    copy = materialise(spark.range(5))
    assert copy.count() == 5
    assert drop_copies(spark) == 1 and drop_copies(spark) == 0
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        copy.count()


def test_copies_of_two_live_results(spark):
    with copies(spark):
        one = materialise(spark.range(3))
        with copies(spark):
            two = materialise(spark.range(4))
            assert two.count() == 4
        assert one.count() == 3
        with pytest.raises(Exception, match="(?i)not.exist|not.found"):
            two.count()
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        one.count()


# --- dates -----------------------------------------------------------------


def one_range(spark):
    return spark.sql("select date'2020-07-01' start_date, date'2020-08-31' end_date")


def test_document_ranges_agree_by_text_and_by_line(spark):
    docs = [("a", "2020-07-01 2020/07/01"), ("b", "x\n2020-07-01\ny 31.8.2020"), ("c", "none"), ("d", "2020-07-01\n2020-07-01")]
    whole = spark.createDataFrame(docs, "doc string, text string")
    lines = whole.select("doc", F.explode(F.split("text", "\n")).alias("text"))
    expect = rows(ranges_of_documents(whole, "doc"), "doc")
    assert rows(ranges_of_lines(lines, "doc"), "doc") == expect
    assert [(r[0], r[1], r[4]) for r in expect] == [
        ("a", 2, "ok"), ("b", 2, "ok"), ("c", 0, "too few dates"), ("d", 1, "too few dates"),
    ]


def test_request_without_a_range_fails(spark):
    docs = spark.createDataFrame([("a", "only 2020-07-01")], "doc string, text string")
    with pytest.raises(Exception, match="two dates"):
        require_range(ranges_of_documents(docs, "doc")).collect()


def test_range_filter_counts_the_end_as_midnight(spark):
    values = ["2020-07-01 00:00:00", "2020-08-31 00:00:00", "2020-08-31 10:00:00", "bad", None]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert filter_by_range(df, one_range(spark), "d").table.count() == 2
    assert filter_by_range(df, one_range(spark), "d", inclusive_day=True).table.count() == 3


def test_range_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("select timestamp_ntz'2020-07-02' as d, 1 as x").write.parquet(str(tmp_path / "t"))
    kept = filter_by_range(spark.read.parquet(str(tmp_path / "t")), one_range(spark)).table
    text = plan(kept)
    assert "Join" not in text
    scan = next(line for line in text.splitlines() if "DataFilters: [isnotnull(d" in line)
    assert "(d#" in scan and "cast(d#" not in scan


def test_date_column_choice(spark):
    assert find_date_column(spark.sql("select 1 id, 2 UpdateTime, 3 `日期`")) == "UpdateTime"
    good = [(f"2020-07-{i:02d}", 20200701, "x") for i in range(1, 9)]
    schema = "w string, n int, v string"
    eight = spark.createDataFrame([*good, ("x", 1, "x"), ("y", 1, "x")], schema)
    assert date_column_by_content(eight) == "w"
    seven = spark.createDataFrame([*good[:7], *[("x", 1, "x")] * 3], schema)
    assert date_column_by_content(seven) is None
    kept = filter_by_range(seven, one_range(spark))
    assert kept.column is None and kept.table.count() == 10
    assert date_column_by_content(spark.sql("select 1 a")) is None


# --- templates -------------------------------------------------------------


def test_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["b", "c", " a"])
    cut = template.project(df, [" a ", "b", "a", "z", "", None])
    assert cut.table.columns == ["b", "a"] and cut.missing == ["z"]
    assert template.project(df, ["q"]).table is None
    assert template.project(spark.sql("select 1 B"), ["b"]).table is None
    both = template.project(spark.sql("select 1 B, 2 b"), ["b"]).table
    assert both.columns == ["b"] and both.first()[0] == 2
    assert template.clean_header([" a ", "b", "a", "", None, "z"]) == ["a", "b", "z"]


def test_all_strings(spark):
    df = spark.sql("select 5.0D a, 12345678.0D b, 1.5D c, double('NaN') d, timestamp'2020-07-01' e, null f, 1e-5D g")
    got = rows(template.all_strings(template.nan_to_null(df)))
    assert got == [("5", "12345678", "1.5", None, "2020-07-01 00:00:00", None, "0.00001")]


def test_conform(spark):
    df = spark.sql("select from_json('{\"GDP\":\"5\",\"x\":\"y\",\"n\":null}', 'map<string,string>') record")
    assert rows(template.conform(df, ["省份", "GDP", "n"])) == [("", "5", None)]
    blank = spark.createDataFrame([("", None), ("", "v")], "a string, b string")
    assert template.keep_filled(blank, ["a", "b"]).count() == 1


def test_overlay(spark):
    header = ["省份", "GDP", None, "省份"]
    sheet = spark.createDataFrame([(1, None, "9"), (4, "old", "tail")], "pos long, `省份` string, GDP string")
    records = spark.createDataFrame([(1, "湖北省", None), (2, None, "5"), (3, "", "")], "pos long, `省份` string, GDP string")
    got = rows(template.overlay(sheet, records, header), "pos")
    assert got == [(1, "湖北省", "9", "湖北省"), (2, None, "5", None), (3, "", "", ""), (4, "old", "tail", None)]
    assert rows(template.overlay(sheet, records.limit(0), header), "pos") == [(1, None, "9", None), (4, "old", "tail", None)]
    assert template.overlay(sheet.limit(0), records, header).count() == 3


def test_fill_many_in_place(spark):
    records = spark.createDataFrame([(1, "x", None), (2, "", "b2")], "pos long, a string, b string")
    headers = spark.createDataFrame([("t", ["b", None, "a", "zz"]), ("u", ["a"]), ("v", [])], "template string, header array<string>")
    sheet = [("t", 1, ["old", "keep"]), ("t", 3, ["tail"]), ("u", 2, ["gone", "beyond"]), ("other", 9, ["no header"])]
    sheet = spark.createDataFrame(sheet, "template string, pos long, cells array<string>")
    got = rows(template.fill_many_in_place(records, headers, sheet), "template", "pos")
    assert got == [
        ("t", 1, ["old", "keep", "x", None]), ("t", 2, ["b2", None, "", None]), ("t", 3, ["tail"]),
        ("u", 1, ["x"]), ("u", 2, ["", "beyond"]), ("v", 1, []), ("v", 2, []),
    ]


def test_fill_many_reads_records_once(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, a string, b string")
    filled = template.fill_many(df, {"t": ["b", "a"], "u": ["a", "zz"]}, ["id"])
    assert rows(filled, "template", "field_no") == [(1, "t", 1, "b", "y"), (1, "t", 2, "a", "x"), (1, "u", 1, "a", "x")]


def test_small_helpers(spark, value):
    assert value(template.empty_template(F.array(F.lit("a"), F.lit("b")))) == '{"a":"","b":""}'
    merged = template.union_records([spark.sql("select 1 a, 2 b"), spark.sql("select 3 b, 4 c")])
    assert rows(merged, "b") == [(1, 2, None), (None, 3, 4)]
    indexed = indexed_records(spark.createDataFrame([(2, None), (1, "x")], "k int, v string"), ["k"], ["k", "v"])
    assert rows(indexed, "row_no") == [(0, '{"0": {"k":1,"v":"x"}}'), (1, '{"1": {"k":2,"v":null}}')]


# --- chunks and Markdown ---------------------------------------------------


def test_numbered_chunks(spark):
    docs = spark.createDataFrame([(2, "p1\n\np2"), (1, "一二。三四。五六七八九。"), (3, " ")], "doc long, text string")
    got = numbered_chunks(docs, document_chunks(F.col("text"), 6), ["doc"])
    assert rows(got.select("id", "doc", "text"), "id") == [
        (1, 1, "一二。三四。"), (2, 1, "五六七八九。"), (3, 2, "p1"), (4, 2, "p2"),
    ]


def test_chunking_needs_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "x")], "doc long, text string")
    text = plan(docs.select("doc", F.explode(document_chunks(F.col("text"), 6))))
    assert "Python" not in text and "Exchange" not in text
    assert retrieval_nodes(docs, "doc").first().text == "x"


def test_markdown(spark):
    sheet = [("s", 0, ["a", None]), ("s", 1, [None, None]), ("s", 2, ["1", "2", "3"]), ("e", 0, [None])]
    df = spark.createDataFrame(sheet, "sheet string, row_idx long, cells array<string>")
    assert rows(markdown.markdown_tables(df, ["sheet"])) == [("s", 0, "| a |  |  |\n| --- | --- | --- |\n| 1 | 2 | 3 |")]
    parts = rows(markdown.markdown_tables(df, ["sheet"], part_rows=2), "part")
    assert [p[1] for p in parts] == [0, 1]
    assert rows(markdown.header_rows(df, ["sheet"])) == [("s", ["a", None])]


# --- extraction ------------------------------------------------------------

FIELDS = ["国家/地区", "大洲", "病例数", "GDP", "日期"]


def test_rules(spark):
    texts = [
        "**湖北省** 病例数 5 例，GDP 约 4.5 万亿元，日期 2020年7月1日", "Ohio 全零报告。国家/地区: Ohio", None, "   ", "江苏省 2020-01-05 与 2020-02-01",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    kinds = {"病例数": "count", "GDP": "number"}
    got = {r[0]: r[1:] for r in rows(extract_records(df, FIELDS, rule_extractor(FIELDS, kinds)))}
    assert got == {
        0: ("湖北省", "Asia", "5", "4500000000000", "2020-07-01"),
        1: ("Ohio", "", "0", "", ""),
        4: ("江苏省", "Asia", "", "", "2020-01-05"),
    }


def test_injected_extractor(spark):
    import pandas as pd

    @F.pandas_udf("string")
    def model(texts: pd.Series) -> pd.Series:
        return "```json\n{\"国家/地区\": \"湖北省\", \"extra\": \"" + texts + "\"}\n```"

    df = spark.createDataFrame([(1, "t")], "id int, text string")
    got = extract_records(df, ["国家/地区", "大洲"], lambda text: from_replies(model(text)))
    assert rows(got) == [(1, "湖北省", "Asia")]
    rejected = extract_records(df, ["国家/地区"], lambda text: from_replies(F.concat(text, F.lit("no json"))))
    assert rejected.count() == 0


def test_lookup_default(spark):
    df = spark.createDataFrame([(" 湖北省", ""), ("湖北省", "set"), ("Ohio", ""), ("湖北省", None)], "r string, c string")
    expect = ["Asia", "set", "", "Asia"]
    assert [x.c for x in default_from_list(df, "r", "c", ["湖北省"], "Asia").collect()] == expect
    members = spark.createDataFrame([("湖北省",), ("湖北省",)], "r string")
    assert sorted(x.c for x in default_from_table(df, "r", "c", members, "Asia").collect()) == sorted(expect)


def test_instruction_names_the_fields(value):
    text = value(instruction(["甲", "乙"], F.lit("body")))
    assert "- 甲\n- 乙\n" in text and text.endswith("body")


# --- retrieval -------------------------------------------------------------


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["the"] * 20
    return [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60)))) for i in range(n)]


def brute_bm25(docs, query):
    """Okapi scores by the textbook formula."""
    counts = {i: Counter(t.split()) for i, t in docs}
    mean = sum(sum(c.values()) for c in counts.values()) / len(docs)
    df = Counter(w for c in counts.values() for w in c)
    raw = {w: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: floor if r < 0 else r for w, r in raw.items()}
    scores = {}
    for i, c in counts.items():
        length = sum(c.values())
        scores[i] = sum(
            idf.get(w, 0) * c[w] * 2.5 / (c[w] + 1.5 * (1 - 0.75 + 0.75 * length / mean)) for w in query.split()
        )
    return scores


def test_bm25_equals_brute_force(spark):
    docs = corpus()
    index = bm25.build_index(spark.createDataFrame(docs, "node_id long, text string"))
    for query in ("w1 w2 the w1", "the", "absent"):
        expect = brute_bm25(docs, query)
        got = {r.node_id: r.score for r in bm25.all_scores(index, query).collect()}
        assert got.keys() == expect.keys()
        assert all(abs(got[i] - expect[i]) < 1e-9 for i in expect), query


def test_search_modes(spark):
    docs = corpus(5, 20)
    index = bm25.build_index(spark.createDataFrame(docs, "node_id long, text string"))
    queries = spark.createDataFrame([(1, "w1 w3"), (2, "absent")], "query_id long, query string")
    every = fusion.search_above(queries, "bm25", 0.0, index=index).collect()
    assert len([r for r in every if r.query_id == 2]) == 20
    expect = brute_bm25(docs, "w1 w3")
    assert sorted((round(r.score, 9) for r in every if r.query_id == 1), reverse=True) == sorted(
        (round(s, 9) for s in expect.values() if s >= 0), reverse=True
    )
    some = fusion.search_above(queries, "bm25", 1.0, index=index).collect()
    assert {r.node_id for r in some} == {i for i, s in expect.items() if s >= 1.0}
    with pytest.raises(ValueError, match="unknown mode"):
        fusion.search_above(queries, "other")


def test_custom_tokenizer(spark):
    nodes = spark.createDataFrame([(1, "合同金额"), (2, "合作社")], "node_id long, text string")
    index = bm25.build_index(nodes, words_and_bigrams)
    queries = spark.createDataFrame([(1, "金额")], "query_id long, query string")
    assert [r.node_id for r in bm25.best_matches(index, queries, tokenizer=words_and_bigrams).collect()] == [1]


def vectors(spark, n=50, dim=4):
    rnd = random.Random(1)
    data = [(i, [rnd.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    data.append((n, [0.0] * dim))
    return data, spark.createDataFrame(data, "node_id long, embedding array<float>")


def brute_cosine(data, query):
    def cos(a, b):
        length = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / length, 4) if length else None

    scored = [(i, cos(v, query)) for i, v in data]
    return sorted(((-s, i) for i, s in scored if s is not None))


@pytest.mark.parametrize("pack, sent", [(64, 0), (4 << 20, 0), (64, 32 << 20), (4 << 20, 32 << 20)])
def test_nearest_equals_brute_force(spark, monkeypatch, pack, sent):
    """Small packs or large ones, queries broadcast or dealt: the same neighbours."""
    monkeypatch.setattr(vector, "PACK_BYTES", pack)
    monkeypatch.setattr(vector, "BROADCAST_BYTES", sent)
    data, nodes = vectors(spark)
    queries = nodes.filter("node_id < 6").withColumnRenamed("node_id", "query_id")
    got = rows(vector.nearest(nodes, queries, 7, decimals=4), "query_id", "rank")
    for q in range(6):
        expect = [i for _, i in brute_cosine(data, data[q][1])[:7]]
        assert [r[1] for r in got if r[0] == q] == expect
    close = vector.above(nodes, queries, 0.5, decimals=4)
    assert close.count() == sum(1 for q in range(6) for s, _ in brute_cosine(data, data[q][1]) if -s >= 0.5)


def test_vectors_of_text_ids_lengths_and_ties(spark):
    """Ids of any type; ties by id; what cannot be compared is left out and counted."""
    nan = float("nan")
    data = [(f"p#{i}", [1.0, 0.0]) for i in range(40)] + [("q", [0.0, 2.0]), ("big", [1e300, 1e300]), ("three", [1.0, 0.0, 0.0])]
    odd = [("a", None), ("b", []), ("c", [1.0, None]), ("d", [nan, 1.0]), ("e", [0.0, 0.0]), ("f", [1.0]), (None, [1.0, 0.0])]
    nodes = spark.createDataFrame(data + odd, "node_id string, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([("x", [3.0, 0.0]), ("y", [0.0, 0.0]), ("z", [1.0, 1.0, 0.0])], "query_id string, embedding array<double>")
    got = rows(vector.nearest(nodes.filter("node_id IS NOT NULL"), queries, 12).select("query_id", "rank", "node_id", "score"), "query_id", "rank")
    ties = sorted(f"p#{i}" for i in range(40))[:12]
    assert got == [("x", i + 1, t, 1.0) for i, t in enumerate(ties)] + [("z", 1, "three", 0.707107)]
    assert ("x", "big", 0.707107) in rows(vector.above(nodes, queries, 0.7))
    assert dict(rows(vector.left_out(nodes, queries))) == {"missing": 2, "incomplete": 2, "zero": 1, "length": 1}
    assert vector.nearest(nodes.limit(0), queries).count() == 0 and vector.nearest(nodes, queries.limit(0)).count() == 0


@pytest.mark.parametrize("bits, pushed", [(0, 2000), (3, 1), (8, 2000)])
def test_kept_index_rules_out_stretches(spark, tmp_path, monkeypatch, bits, pushed):
    """Whatever is skipped, the best nodes of a kept index are those of all scores, ties included."""
    monkeypatch.setattr(bm25, "STRETCH_BITS", bits)
    monkeypatch.setattr(bm25, "SKIP_FROM", 1)
    monkeypatch.setattr(bm25, "PUSHED_TERMS", pushed)
    docs = [(f"p#{i}", t) for i, t in corpus(11, 150)] + [(f"copy#{i}", "w1 w2 the the") for i in range(30)]
    nodes = spark.createDataFrame(docs, "node_id string, text string").repartition(5)
    index = bm25.load_or_build_index(spark, str(tmp_path), lambda: nodes)
    again = bm25.load_or_build_index(spark, str(tmp_path), lambda: pytest.fail("built twice"))
    texts = {1: "w1 w2", 2: "w3", 3: "the w7 w7 w9", 4: "absent", 5: "w11 the"}
    queries = spark.createDataFrame(list(texts.items()), "query_id long, query string")
    for k in (1, 4, 40):
        for held in (index, again):
            got = rows(bm25.best_matches(held, queries, k).select("query_id", "rank", "node_id"), "query_id", "rank")
            want = []
            for q, text in texts.items():
                shared = {i for i, t in docs if set(t.split()) & set(text.split())}
                scored = sorted((-round(s, 6), i) for i, s in brute_bm25(docs, text).items() if i in shared)
                want += [(q, n + 1, i) for n, (_, i) in enumerate(scored[:k])]
            assert got == want
    scan = again.postings.filter(bm25._term_filter(bm25.query_terms(queries)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in scan if pushed > 1 else "GreaterThanOrEqual(term" in scan


def sentence_parts(text, size):
    parts = []
    for s in re.split(r"(?<=[。！？!?\n])|(?<=\.)(?=[\t\n\x0b\f\r ])", text):
        tokens = re.findall(r"[\t\n\x0b\f\r ]*(?:[\u4e00-\u9fff]|[^\t\n\x0b\f\r \u4e00-\u9fff]+)[\t\n\x0b\f\r ]*", s)
        if len(tokens) > size:
            parts += [("".join(tokens[i : i + size]), len(tokens[i : i + size])) for i in range(0, len(tokens), size)]
        elif s:
            parts.append((s, len(tokens)))
    return parts


def brute_windows(text, size, overlap):
    parts, out, a, n = sentence_parts(text, size), [], 0, 0
    for i, (_, c) in enumerate(parts):
        if n + c > size and a < i:
            out.append((a, i))
            j, n = i, 0
            while j - 1 > a and n + parts[j - 1][1] <= min(overlap, size - c):
                j, n = j - 1, n + parts[j - 1][1]
            a = j
        n += c
    if parts:
        out.append((a, len(parts)))
    texts = ["".join(s for s, _ in parts[a:b]) for a, b in out]
    return [t for t in texts if t.strip()]


def test_sentence_windows(spark):
    rnd = random.Random(4)
    texts = ["", " \n\n ", "one. two three! four? five", "没有标点的很长的一句话" * 9, "短句。" * 40, "v1.2 is a.b. ok", "x " * 100, "a" * 50 + "中文" * 30]
    for _ in range(30):
        texts.append("".join(rnd.choice(["word ", "w. ", "中", "文。", "! ", "\n", "long-token, ", " ", "？"]) for _ in range(rnd.randint(1, 150))))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc long, text string")
    for size, overlap in ((7, 3), (20, 0), (20, 19), (512, 50)):
        got = {}
        for doc, i, text in rows(sentence_nodes(docs, "doc", size, overlap), "doc", "id"):
            got.setdefault(doc, []).append(text)
            assert i == len(got[doc])
        assert got == {i: w for i, t in enumerate(texts) if (w := brute_windows(t, size, overlap))}
        if overlap == 0:
            assert all("".join(got.get(i, [])).split() == t.split() for i, t in enumerate(texts))


def test_fusion(spark):
    a = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "query_id long, node_id long, rank int")
    b = spark.createDataFrame([(1, 7, 1), (1, 9, 2)], "query_id long, node_id long, rank int")
    got = {r.node_id: r.score for r in fusion.fuse(a, b).collect()}
    assert got == {7: 2 / 60, 8: 1 / 61, 9: 1 / 61}
    assert [r.node_id for r in fusion.fused_top(fusion.fuse(a, b), 2).orderBy("rank").collect()] == [7, 8]


def test_hybrid_over_all_equals_large_k(spark):
    docs = corpus(9, 50)
    _, nodes = vectors(spark)
    index = bm25.build_index(spark.createDataFrame(docs, "node_id long, text string"))
    queries = nodes.filter("node_id < 3").select(
        F.col("node_id").alias("query_id"), F.lit("w1 the w5").alias("query"), "embedding"
    )
    whole = rows(fusion.hybrid(index, nodes, queries, None), "query_id", "node_id")
    large = rows(fusion.hybrid(index, nodes, queries, 1000), "query_id", "node_id")
    assert [(q, n, round(s, 9)) for q, n, s in whole] == [(q, n, round(s, 9)) for q, n, s in large]


def test_hit_list(spark):
    hits = spark.range(25).select(F.lit(1).alias("query_id"), F.col("id").alias("node_id"), (F.col("id") * 1.0).alias("score"))
    shown, rest = fusion.first_hits(hits)
    assert shown.count() == 10 and rest.first().n_more == 15
    nodes = spark.createDataFrame([(3, "t", {"file_name": "f"})], "node_id long, text string, metadata map<string,string>")
    found = fusion.with_sources(hits, nodes)
    assert rows(found.select("node_id", "text", F.col("metadata")["file_name"])) == [(3, "t", "f")]
    assert "BroadcastHashJoin" in plan(found)


# --- pool and status -------------------------------------------------------


def test_pool(spark):
    docs = spark.createDataFrame([(1, "金额 3.5万元 于 2020-07-01")], "doc long, text string")
    names = spark.createDataFrame([(0, "amount", [1.0, 0.0]), (1, "date", [0.0, 1.0])], "node_id long, field string, embedding array<float>")
    wanted = spark.createDataFrame([(0, "合同金额", [0.9, 0.1]), (1, "other", [-1.0, -1.0])], "query_id long, template_field string, embedding array<float>")
    tiers = spark.createDataFrame([(1, "amount", "35,000", 0.95, "model")], "doc long, field string, value string, confidence double, tier string")
    got = rows(pooled_values(docs, "doc", wanted, names, tiers, threshold=0.5))
    assert got == [(1, "合同金额", "amount", "35,000", 0.95, "model", "ok")]
    low = spark.createDataFrame([("a", 0.5), ("b", 0.8)], "value string, confidence double")
    assert [r.review for r in pool.flag_review(low).orderBy("value").collect()] == ["review", "ok"]


def test_stats(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["done"] * 3 + ["skipped", "failed"])], "id int, status string")
    assert status.run_stats(df).first().asDict() == {"total": 5, "success": 4, "failed": 1, "skipped": 1}
    marked = status.mark_existing(spark.range(3), spark.range(1, 2), ["id"])
    assert rows(marked, "id") == [(0, "done"), (1, "skipped"), (2, "done")]
    assert rows(status.not_existing(spark.range(3), spark.range(1, 2), ["id"]), "id") == [(0,), (2,)]


def test_first_hits_reads_found_hits_once_written(spark):
    hits = spark.range(40).selectExpr("id % 2 query_id", "id node_id", "cast(id as double) score")
    shown, rest = fusion.first_hits(hits, 3)
    assert shown.inputFiles() and sorted(shown.inputFiles()) == sorted(rest.inputFiles())
    assert sorted((r.query_id, r.node_id) for r in shown.collect()) == [(0, 34), (0, 36), (0, 38), (1, 35), (1, 37), (1, 39)]
    assert {(r.query_id, r.n_more) for r in rest.collect()} == {(0, 17), (1, 17)}


def test_kept_postings_are_sorted_in_bounded_parts(spark, tmp_path, monkeypatch):
    nodes = spark.range(4000).selectExpr("id node_id", "concat_ws(' ', transform(sequence(1, 40), i -> cast(hash(id, i) as string))) text").coalesce(1)
    asked = nodes.filter("node_id % 500 = 0").selectExpr("node_id query_id", "text query")
    whole = bm25.build_index(nodes, path=str(tmp_path / "whole"))
    monkeypatch.setattr(bm25, "SORT_BYTES", 200_000)
    parts = bm25.build_index(nodes, path=str(tmp_path / "parts"))
    assert len(whole.postings.inputFiles()) == 1 and len(parts.postings.inputFiles()) > 3
    found = [{(r.query_id, r.node_id, r.score) for r in bm25.best_matches(i, asked).collect()} for i in (whole, parts)]
    assert found[0] == found[1] and len(found[0]) >= 8


def test_ranks_of_all_nodes_without_looking_up_ids(spark):
    """An index used once gives ids with its scores; ranks are written without scores; repeated ids stay apart."""
    docs = [(i % 37, f"red {'fox ' * (i % 5)} word{i % 11}") for i in range(90)] + [(99, None)]
    index = bm25.build_index(spark.createDataFrame(docs, "doc_id long, text string"), node="doc_id")
    queries = spark.createDataFrame([(1, "fox word3"), (2, "red"), (3, "absent")], "query_id long, query string")
    hits = bm25.matched_scores(index, queries).withColumn("score", F.round("score", 6))
    assert "node_id" in index.postings.columns
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Aggregate [query_id") and "node_id" in plan.splitlines()[0]  # no join above the scores
    got = sorted((r.query_id, r.rank, r.node_id) for r in fusion.ranked_all(hits).collect())
    want = []
    for q in (1, 2):
        own = sorted((-r.score, r.node_id) for r in hits.filter(F.col("query_id") == q).collect())
        want += [(q, i + 1, n) for i, (_, n) in enumerate(own)]
    assert got == want and fusion.ranked_all(hits).columns == ["query_id", "node_id", "rank"]

"""The queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions.binding import let
from formweave.llm.bpe import round_trip
from formweave.llm.common import table
from formweave.llm.exact_dedup import exact_groups
from formweave.llm.language import predict_language
from formweave.llm.licenses import scan_licenses
from formweave.llm.near_dedup import near_classes
from formweave.llm.negatives import mine_negatives
from formweave.llm.neighbours import nearest
from formweave.llm.packing import pack_documents
from formweave.llm.passages import remove_repeats
from formweave.llm.periodic import RUN_TYPE, periodic_runs
from formweave.llm.pitman_yor import score_language
from formweave.llm.quality import score_quality
from formweave.llm.toxicity import score_toxicity

QUALITY_CUT = 0.3
TOXIC_CUT = 0.7


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = near_classes(table(spark, sf_dir, "documents"))
    return classes


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_CUT).cast("int"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth text, by a hash of its id, repeats some of its words to the end."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")

    def repeated(w: Column) -> Column:
        g, n = F.floor(hashed / 10), F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(w, lambda _, i: F.get(w, place(i))), " ")).otherwise("")

    text = F.when(hashed % 10 == 0, let(words, repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))

    def greater(best: Column, run: Column) -> Column:
        """Length by period as a fraction; runs come by start, then period, so the first of equals stays."""
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    runs = found.withColumn("best", F.aggregate("runs", F.lit(None).cast(RUN_TYPE), greater))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_neighbours": op3_neighbours,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_language_model": op6_language_model,
    "op7_quality": op7_quality,
    "op8_near_dedup": op8_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_language": op11_language,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

# crc32 of the id's digits, bit by bit; every tenth text repeats; then all pairs of equal words of a
# document, joined to stretches of one distance, of which the smallest stays.
PERIODIC_RUNS = r"""
    WITH split AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
            flatten(list_transform(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)),
                lambda b: list_transform(range(8), lambda k: (b >> k::INTEGER) & 1)))::BIGINT[] AS bits
        FROM documents),
    hashed AS (
        SELECT doc_id, w, len(w) AS n,
            xor(list_reduce(list_concat([4294967295::BIGINT], bits),
                lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) AS h
        FROM split),
    chosen AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM hashed),
    planted AS (SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS again, a, 1 + (n - a) // (3 + g % 8) AS p FROM chosen),
    texts AS (
        SELECT doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
        FROM planted),
    words AS MATERIALIZED (SELECT doc_id, n, i - 1 AS i, w[i] AS word FROM texts, unnest(range(1, n + 1)) AS r(i)),
    same AS (
        SELECT doc_id, b.i - a.i AS q, a.i AS i
        FROM words a JOIN words b USING (doc_id, word)
        WHERE b.i > a.i AND 3 * (b.i - a.i) <= a.n),
    stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + q AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM same)
        GROUP BY doc_id, q, part
        HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
    best AS (
        SELECT doc_id, count(*) AS n_runs,
            first(struct_pack(s := start, m := length, q := period) ORDER BY length::DOUBLE / period DESC, start, period) AS r,
            string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY doc_id),
    dropped AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) AS r(i)),
    left_over AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
        FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, r.s AS start, r.m AS length, r.q AS period,
        1000 * r.m // r.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(l.text, '')) AS collapsed_sha256
    FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""

HARD_NEGATIVES = """
    WITH rows AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
        FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 10
"""

ORACLES = {
    "op4_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER copies AS keep_id,
               count(*) OVER copies AS group_size,
               doc_id = max(doc_id) OVER copies AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW copies AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_hard_negatives": HARD_NEGATIVES,
}

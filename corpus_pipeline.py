"""The corpus pipeline: stages over documents, each written and read again.

A stage works on all rows that the one before kept. All but the last return the columns
of ``documents``; where a stage changes a text, n_chars follows it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.llm.common import BATCH_BYTES, table
from formweave.llm.exact_dedup import exact_groups
from formweave.llm.near_dedup import near_classes, text_key
from formweave.llm.packing import pack_documents
from formweave.llm.passages import remove_repeats
from formweave.llm.quality import keep_quality
from formweave.session import shared_dir

QUALITY_CUT = 0.3


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have."""
    out = []
    for name in names:
        while name in docs.columns:
            name += "_"
        out.append(name)
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the cut go; nothing else changes. Rows of one id with different
    texts are judged each, null texts as empty ones, repeated rows alike; an empty table stays empty."""
    _bounded(spark)
    return keep_quality(docs, table(spark, sf_dir, "labels"), QUALITY_CUT)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null ones being empty, the row with the largest doc_id stays; of rows
    repeated whole, one. An empty table stays empty."""
    _bounded(spark)
    id_, sha_, kept = _free(docs, "copy_id", "copy_sha", "copy_kept")
    groups = exact_groups(docs).filter("group_size > 1")
    groups = groups.select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha_), F.col("kept").alias(kept)).distinct()
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    joined = docs.join(groups, docs["doc_id"].eqNullSafe(F.col(id_)) & (sha == F.col(sha_)), "left")
    # Only rows with copies can be repeated whole.
    several = joined.filter(F.col(kept)).dropDuplicates([id_, sha_])
    return joined.filter(F.col(kept).isNull()).select(*docs.columns).unionByName(several.select(*docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the text of the smallest doc_id stays. Rows of one id with
    different texts are judged each, null texts as empty ones; an empty table stays empty."""
    _bounded(spark)
    id_, key = _free(docs, "copy_id", "copy_key")
    classes, _ = near_classes(docs, with_key=True)
    gone = classes.filter("NOT kept").select(F.col("doc_id").alias(id_), F.col("key").alias(key)).distinct()
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (text_key("text") == F.col(key))
    return docs.join(gone, same, "left_anti")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts, in whole characters; a document
    of which nothing is left goes. Texts that were empty before stay."""
    _bounded(spark)
    cut = remove_repeats(docs, texts=True, carry=docs.columns)
    changed = F.col("n_removed") > 0
    given = {c: F.col(f"__{c}") for c in docs.columns}
    n_chars = F.when(changed, F.length("text")).otherwise(given["n_chars"]).cast(docs.schema["n_chars"].dataType)
    columns = given | {"text": F.when(changed, F.col("text")).otherwise(given["text"]), "n_chars": n_chars}
    return cut.filter(~changed | (F.col("text") != "")).select(*[v.alias(c) for c, v in columns.items()])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    _bounded(spark)
    return pack_documents(docs)


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("suffix-array dedup", passages),
    ("packing", packing),
]

# Trained classifiers, sampled hash functions and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage reads what the last one wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

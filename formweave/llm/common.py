"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts go to Python in batches of at most this many bytes, so that a run of
# very long documents does not fill a worker.
BATCH_BYTES = str(8 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python stages ask for small batches of text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row; a null text is the empty text."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(0))


# What a worker keeps between tasks, by the function that forgets it.
CACHES: list[Callable[[], None]] = []


def release() -> None:
    """Forget what earlier work of this worker left behind; workers outlive their stage."""
    for forget in CACHES:
        forget()


def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in stream if b.num_rows)


def piece_splitter() -> Callable[[str], list[str]]:
    """Splits a text by the public byte-level pattern.

    Texts of ASCII and Latin-1 letters alone, the most common ones, take the same pattern
    with its classes written out for that range, which the standard library runs faster.
    """
    letters = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
    space = "\t-\r "
    narrow = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[0-9]+| ?[^{space}{letters}0-9]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall
    beyond = re.compile(f"[^\x00-\x7f{letters}]").search
    wide = regex.compile(public_tokenizers.PATTERN).findall
    return lambda text: wide(text) if beyond(text) else narrow(text)

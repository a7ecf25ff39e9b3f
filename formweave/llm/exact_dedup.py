"""Exact deduplication by counting quotient filters.

Every task builds a counting quotient filter over the fingerprints of its own
texts: a fingerprint's high bits (the quotient) name a slot, the low bits (the
remainder) are stored there in sorted order beside a count. Filters are cut into
segments by the highest bits. Segments of all tasks merge without loss: both
sides are sorted by (quotient, remainder), so merging is one pass that adds the
counts of equal remainders. Only fingerprints counted more than once send their
texts to the byte comparison; all others are known to be single.

A group of copies, however large, is one entry with a count in each filter and
one partial row per task in the byte comparison.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import whole_texts
from formweave.session import materialise

# Entries of one merged segment, on average; the number of segments follows
# from the number of rows.
SEGMENT_ENTRIES = 1 << 16
_HEAD = struct.Struct("<QBB")
_SEGMENT = pa.schema([("segment", pa.int64()), ("filter", pa.binary())])
_COUNTED = pa.schema([("fp", pa.int64()), ("copies", pa.int64())])


def encode(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter over sorted distinct ``bits``-bit values with their counts.

    The quotient has about as many values as there are entries. Stored are an
    occupancy bit for each slot, a run-end bit for each entry, the remainders
    in (quotient, remainder) order, one bit for each entry counted once, and
    the other counts.
    """
    n = len(values)
    q = min(bits, max(0, (n - 1).bit_length())) if n else 0
    r = bits - q
    quotient = values >> np.uint64(r) if r < 64 else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient.astype(np.int64)] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
    width = np.uint32 if r <= 32 else np.uint64
    rest = (values & np.uint64((1 << r) - 1)).astype(width)
    parts = [np.packbits(occupied), np.packbits(ends), rest, np.packbits(counts > 1), counts[counts > 1].astype(np.uint64)]
    return _HEAD.pack(n, bits, q) + b"".join(p.tobytes() for p in parts)


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values of a filter and their counts."""
    n, bits, q = _HEAD.unpack_from(data)
    at, r = _HEAD.size, bits - q

    def take(kind, size):
        nonlocal at
        out = np.frombuffer(data, kind, size, at)
        at += out.nbytes
        return out

    occupied = np.unpackbits(take(np.uint8, -(-(1 << q) // 8)), count=1 << q)
    ends = np.unpackbits(take(np.uint8, -(-n // 8)), count=n)
    rest = take(np.uint32 if r <= 32 else np.uint64, n).astype(np.uint64)
    many = np.unpackbits(take(np.uint8, -(-n // 8)), count=n).astype(bool)
    counts = np.ones(n, np.uint64)
    counts[many] = take(np.uint64, int(many.sum()))
    run = np.cumsum(ends) - ends  # the run that an entry stands in
    quotient = np.flatnonzero(occupied).astype(np.uint64)[run] if n else rest
    return (quotient << np.uint64(r) if r < 64 else np.uint64(0)) | rest, counts


def merge(filters: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Merge filters over the same segment: sorted remainders meet, counts add."""
    parts = [decode(f) for f in filters]
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def segment_bits(rows: int) -> int:
    return max(4, (max(rows, 1) // SEGMENT_ENTRIES).bit_length() + 4)


def partition_filters(fingerprints: DataFrame, top: int) -> DataFrame:
    """One filter per task and segment over the column ``fp``: (segment, filter)."""
    bits = 64 - top

    def build(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in stream if b.num_rows]
        if not held:
            return
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        segments = (values >> np.uint64(bits)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, segments[1:] != segments[:-1]))
        low = values & np.uint64((1 << bits) - 1)
        for a, b in zip(cuts, np.append(cuts[1:], len(values))):
            yield pa.record_batch([[int(segments[a])], [encode(low[a:b], counts[a:b], bits)]], schema=_SEGMENT)

    return fingerprints.select("fp").mapInArrow(build, "segment long, filter binary")


def repeated_fingerprints(filters: DataFrame, top: int) -> DataFrame:
    """Merge each segment's filters; the fingerprints counted more than once: (fp, copies)."""
    bits = 64 - top

    def merged(segment: pa.Table) -> pa.Table:
        values, counts = merge(segment["filter"].to_pylist())
        values, counts = values[counts > 1], counts[counts > 1]
        values = values | np.uint64(segment["segment"][0].as_py() << bits)
        return pa.table([values.view(np.int64), counts.astype(np.int64)], schema=_COUNTED)

    return filters.groupBy("segment").applyInArrow(merged, "fp long, copies long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Groups of equal texts over all rows of ``docs`` (doc_id, text).

    Returns per row: doc_id, keep_id (largest doc_id of the row's group),
    group_size, kept, text_sha256. Null text is the empty text. Rows repeated
    whole share a doc_id and stay or go together; a null doc_id never beats
    another, and stays only where all ids of its text are null. An empty table
    gives an empty table. Other columns are not looked at.
    """
    texts = whole_texts(docs)
    top = segment_bits(texts.count())
    filters = partition_filters(texts.select(F.xxhash64("text").alias("fp")), top)
    repeated = materialise(repeated_fingerprints(filters, top).select("fp"))

    # Byte verification: texts whose fingerprint repeats are grouped by their bytes.
    suspects = texts.withColumn("fp", F.xxhash64("text")).join(repeated, "fp", "left_semi")
    verified = materialise(
        suspects.groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    narrow = texts.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (
        narrow.join(verified, "text_sha256", "left")
        .withColumn("keep_id", keep_id)
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )

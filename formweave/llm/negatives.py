"""Hard negatives by a vertical scan with branch and bound over dimensions.

Rows are dealt into blocks of bounded size, and a block is held by columns: one array for each
dimension. An anchor reads the dimensions in descending magnitude of its own components, a few at a
time, and adds them to the partial products of the candidates left. What the dimensions
not yet read can add is bounded by their smallest and largest values in the
block; candidates that can't reach the anchor's k best, or its windows, leave the
candidate set, until the products left are exact.

Two such scans follow each other: one finds each anchor's positives, among rows of its label; the
other, for each positive, the best rows of other labels within the window that the positive's score sets.

Anchors are sent to the blocks, not rows to the anchors; each task holds one block and lets
the anchors pass by, in order of arrival. A label or a vector that many rows share is spread over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.common import batches
from formweave.session import materialise

BLOCK = 32_768
STEP = 8  # dimensions read between two cuts of the candidates
# Products of larger components need not fit a long.
COMPONENT_LIMIT = 1 << 26

_STREAM = "unit int, anchor boolean, id long, label long, key long, vector array<int>, scores array<long>, ids array<long>"
_POSITIVES = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])
_NEGATIVES = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])


@dataclass
class Block:
    """Rows by columns: one array of all rows for each dimension."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Block:
        columns = np.ascontiguousarray(rows.T, dtype=np.float64)
        return cls(ids, labels, columns, columns.min(1, initial=0), columns.max(1, initial=0))


Cut = Callable[[np.ndarray, np.ndarray], np.ndarray]


def scan(block: Block, vector: np.ndarray, candidates: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that ``cut`` left, and their products with ``vector``.

    ``cut`` is given the least and the largest product that each candidate can still
    have, and says which to keep. Both are exact at the end.
    """
    size = min(len(vector), len(block.columns))  # missing components count as 0
    vector = vector[:size]
    bound = float(np.abs(vector).max(initial=0)) * float(max(-block.least.min(initial=0), block.most.max(initial=0), 0)) * size
    number = np.float64 if bound < 2**53 else np.int64  # sums are exact in either
    vector = vector.astype(number)
    order = np.argsort(-np.abs(vector), kind="stable")
    order = order[vector[order] != 0]
    ends = vector[order] * block.least[order].astype(number), vector[order] * block.most[order].astype(number)
    left = [np.append(np.cumsum(e[::-1])[::-1], 0) for e in (np.minimum(*ends), np.maximum(*ends))]
    partial = np.zeros(len(candidates), number)
    for a in range(0, len(order), STEP):
        read = order[a : a + STEP]
        columns = block.columns[read]
        if len(candidates) < len(block.ids):
            columns = columns[:, candidates]
        partial += vector[read] @ columns.astype(number, copy=False)
        end = min(a + STEP, len(order))
        keep = cut(partial + left[0][end], partial + left[1][end])
        if not keep.all():
            candidates, partial = candidates[keep], partial[keep]
        if not len(candidates):
            break
    return candidates, partial.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; smaller than any where there are fewer."""
    return np.partition(values, -k)[-k] if len(values) >= k else -math.inf


def best_of_label(block: Block, id_: int, label: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of the label, best first, ties to the smaller id."""
    start = np.flatnonzero((block.labels == label) & (block.ids != id_))
    at, score = scan(block, vector, start, lambda low, high: high >= _kth(low, k))
    order = np.lexsort([block.ids[at], -score])[:k]
    return block.ids[at][order], score[order]


def best_in_windows(block: Block, label: int, vector: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window the k best rows of other labels with a score inside it."""

    def cut(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for a, b in set(windows):
            surely = low[(low >= a) & (high <= b)]
            keep |= (high >= max(a, _kth(surely, k))) & (low <= b)
        return keep

    at, score = scan(block, vector, np.flatnonzero(block.labels != label), cut)
    out = []
    for a, b in windows:
        inside = np.flatnonzero((score >= a) & (score <= b))
        order = inside[np.lexsort([block.ids[at][inside], -score[inside]])][:k]
        out.append((block.ids[at][order], score[order]))
    return out


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length; shorter ones are filled with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _blocks(stream: Iterable[pa.RecordBatch]) -> Iterator[tuple[Block, Iterator[tuple]]]:
    """Each unit's block, then its anchors as (id, label, key, vector, scores, ids)."""
    held: list[tuple] = []
    block, unit = None, None
    for b in batches(stream):
        units, anchor = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((units[1:] != units[:-1]) | (anchor[1:] != anchor[:-1])) + 1
        for a, e in zip([0, *edges], [*edges, len(units)]):
            part = b.slice(a, e - a)
            if units[a] != unit:
                held, block, unit = [], None, units[a]
            ids, labels, matrix = part.column(2).to_numpy(), part.column(3).to_numpy(), _matrix(part.column(5))
            if not anchor[a]:
                held.append((ids, labels, matrix))
                continue
            if block is None:
                if not held:
                    continue
                width = max(m.shape[1] for _, _, m in held)
                rows = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m in held])
                block = Block.of(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), rows)
                held = []
            yield block, zip(ids, labels, part.column(4).to_numpy(), matrix, part.column(6).to_pylist(), part.column(7).to_pylist())


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, kernel, schema: str) -> DataFrame:
    """Every anchor meets every block: ``kernel`` over tasks that hold blocks and see anchors pass."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n_rows / BLOCK))
    # Few blocks are held by several tasks each, which share the anchors.
    slices = max(1, min(math.ceil(2 * cores / blocks), math.ceil(n_anchors / 32)))
    none = F.lit(None).cast("array<long>")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    held = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    held = held.select((block * slices + F.col("slice")).alias("unit"), F.lit(False).alias("anchor"), "id", "label", "key", "vector", none.alias("scores"), none.alias("ids"))
    part = F.pmod(F.xxhash64("id", "key"), F.lit(slices)).cast("int")
    sent = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.select((F.col("block") * slices + part).alias("unit"), F.lit(True).alias("anchor"), "id", "label", "key", "vector", "scores", "ids")
    dealt = held.unionByName(sent).repartition(blocks * slices, "unit").sortWithinPartitions("unit", "anchor")
    return dealt.mapInArrow(kernel, schema)


def mine_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, embedding, label).

    Components become floor(scale * x); a score is the inner product of two rows.
    Anchors are rows with an id divisible by ``every``; their positives are the best ``positives``
    rows of another id and the same label. For each anchor and positive, the
    best ``negatives`` rows of other labels whose score, times 100, lies between ``low`` and ``high``
    times the positive's. Ties go to the smaller id. Returns anchor_id, positive_id, rank
    (from 1), negative_id, positive_score, negative_score.

    Rows without id, label or vector, with a null or non-finite component, or with one beyond
    2^26 once scaled (products of these need not fit a long), take no part. Rows repeated whole
    count once; different rows of one id are anchors and candidates each, but no positives of each other. Where
    lengths differ, missing components count as 0. An empty table gives an empty
    table; other columns are not looked at.
    """
    x = lambda v: F.floor(v.cast("double") * scale)
    fine = F.forall("embedding", lambda v: F.coalesce((F.abs(v.cast("double") * scale) <= COMPONENT_LIMIT) & ~F.isnan(v.cast("double")), F.lit(False)))
    given = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    given = given.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.transform("embedding", lambda v: x(v).cast("int")).alias("vector"))
    rows = materialise(given.withColumn("key", F.xxhash64("label", "vector")).dropDuplicates(["id", "label", "vector"]))
    anchor = F.col("id") % every == 0
    counts = rows.agg(F.count("*").alias("rows"), F.count(F.when(anchor, 1)).alias("anchors")).first()
    asks = rows.filter(anchor)
    none = F.lit(None).cast("array<long>")

    def find_positives(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asked in _blocks(stream):
            found = [(i, key, *best_of_label(block, i, label, vector, positives)) for i, label, key, vector, _, _ in asked]
            n = [len(f[2]) for f in found]
            who = [np.repeat(np.array([f[c] for f in found], np.int64), n) for c in (0, 1)]
            what = [np.concatenate([f[c] for f in found]).astype(np.int64) for c in (2, 3)]
            yield pa.record_batch([pa.array(c) for c in (*who, *what)], schema=_POSITIVES)

    met = _met(rows, asks.withColumns({"scores": none, "ids": none}), counts["rows"], counts["anchors"], find_positives, "id long, key long, other long, score long")
    best = Window.partitionBy("id", "key").orderBy(F.desc("score"), "other")
    chosen = met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    # At most ``positives`` rows an anchor.
    ranked = F.array_sort(F.collect_list(F.struct("place", "other", "score")))
    listed = chosen.groupBy("id", "key").agg(ranked.alias("list")).select("id", "key", F.col("list.score").alias("scores"), F.col("list.other").alias("ids"))
    windowed = materialise(asks.join(listed, ["id", "key"]))

    def find_negatives(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asked in _blocks(stream):
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for i, label, key, vector, scores, ids in asked:
                windows = [(-(-low * s // 100), high * s // 100) for s in scores]
                for place, (found, score) in enumerate(best_in_windows(block, label, vector, windows, negatives)):
                    fixed = (np.full(len(found), v, np.int64) for v in (i, key, place, ids[place], scores[place]))
                    for column, part in zip(out, (*fixed, found, score)):
                        column.append(part)
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _NEGATIVES)], schema=_NEGATIVES)

    shape = "id long, key long, place int, positive_id long, positive_score long, other long, score long"
    met = _met(rows, windowed, counts["rows"], counts["anchors"], find_negatives, shape)
    order = Window.partitionBy("id", "key", "place").orderBy(F.desc("score"), "other")
    kept = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return kept.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )

"""Packing token sequences by non-negative least squares over a length histogram.

Every document is tokenised once, in Arrow batches, and cut into whole windows
and a remainder. The remainders' lengths, rounded up to a unit, make a histogram
of bounded size. On the driver, all combinations of up to three lengths that fill
a window exactly are listed, and non-negative least squares finds how often each
should be used; the counts are rounded down. A piece's rank within its length class then says
which window it goes to, by arithmetic. What the combinations leave over is
packed greedily: laid end to end, and cut where a window is full.

Ranks come from counts by task, so a class holding most of the pieces is spread
like any other. Nothing but the histogram comes to the driver.
"""

from __future__ import annotations

import os
import uuid
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.common import CACHES, batches, piece_splitter, whole_texts
from formweave.session import materialise, shared_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WINDOW, UNIT, DEPTH, END_ID = 2048, 8, 3, 1
MEMO_PIECES = 800_000
NEW_PIECES = 4_096
GROUP_LENGTH = 1 << 20
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("class", pa.int32()),
        ("task", pa.int64()),
        ("rank", pa.int64()),
        ("row", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_PIECES_SQL = "doc_id long, start long, length long, doc_tokens long, class int, task long, rank long, row long, ids binary"


class Tokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    The library splits a text by the byte-level pattern and merges each part for
    itself; so distinct parts are given to it once, and remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pieces = piece_splitter()
        self.memo: dict[str, bytes] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)  # without places in the text
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, new: list[str]) -> None:
        # What the library returns is many times larger than the ids: few pieces at once.
        for a in range(0, len(new), NEW_PIECES):
            some = new[a : a + NEW_PIECES]
            self.memo.update(zip(some, self._direct(some)))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text; the pieces of some texts are held at a time."""
        group, held = [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= GROUP_LENGTH:
                yield from self._encode(group)
                group, held = [], 0
        if group:
            yield from self._encode(group)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [None if any(s in t for s in self.special) else self.pieces(t) for t in texts]
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        self._learn(list(set().union(*[p for p in split if p is not None]).difference(self.memo)))
        get = self.memo.__getitem__
        for p, t in zip(split, texts):
            yield self._direct([t])[0] if p is None else b"".join(map(get, p))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


CACHES.append(tokenizer.cache_clear)


def cut_pieces(docs: DataFrame, path: str, window: int, unit: int, end_id: int) -> DataFrame:
    """Tokenise, end each document with ``end_id``, cut it, and number each length class within the task."""

    def cut(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end = tokenizer(path), end_id.to_bytes(4, "little")
        task, row = TaskContext.get().partitionId(), 0
        seen: dict[int, int] = {}
        for b in batches(stream):
            out: list[list] = [[] for _ in _PIECES]
            for doc, ids in zip(b.column(0).to_pylist(), tool.encode(x.as_py() for x in b.column(1))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    kind = -(-(len(part) // 4) // unit)
                    rank = seen[kind] = seen.get(kind, -1) + 1
                    for column, value in zip(out, (doc, start, len(part) // 4, total, kind, task, rank, row, part)):
                        column.append(value)
                    row += 1
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _PIECES)], schema=_PIECES)

    return whole_texts(docs).mapInArrow(cut, _PIECES_SQL)


def fill_combinations(classes: list[int], full: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All combinations of up to ``depth`` of the classes that add up to ``full``."""
    have = set(classes)
    found = [(full,)] if full in have else []
    for size in range(1, depth):
        for head in combinations_with_replacement(sorted(have), size):
            last = full - sum(head)
            if last >= head[-1] and last in have:
                found.append((*head, last))
    return found


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """x >= 0 with least |a x - b|, by active sets."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(steps):
        gain = a.T @ (b - a @ x)
        gain[used] = -np.inf
        best = int(gain.argmax()) if len(gain) else -1
        if best < 0 or gain[best] <= slack:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            trial = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if trial.min(initial=1) > 0:
                x[:] = 0
                x[at] = trial
                break
            bad = trial <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - trial[bad], 1e-300))
            x[at] += step * (trial - x[at])
            x[at[x[at] <= slack]] = 0
            used &= x > 0
            if not used.any():
                break
    return x


def plan_windows(histogram: dict[int, int], full: int) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, combination) for a histogram of length classes; never uses more than there is."""
    left = dict(histogram)
    combinations = fill_combinations(list(histogram), full)
    if not combinations:
        return []
    classes = sorted(histogram)
    place = {c: i for i, c in enumerate(classes)}
    a = np.zeros((len(classes), len(combinations)))
    for j, combination in enumerate(combinations):
        for c in combination:
            a[place[c], j] += 1
    wanted = nonnegative_least_squares(a, np.array([histogram[c] for c in classes], float))
    plan = []
    for j in np.argsort(-wanted, kind="stable"):
        combination = combinations[j]
        repeats = min([int(wanted[j] + 0.5), *(left[c] // combination.count(c) for c in set(combination))])
        if repeats > 0:
            plan.append((repeats, combination))
            for c in combination:
                left[c] -= repeats
    return plan


def _slots(plan: list[tuple[int, tuple[int, ...]]]) -> tuple[list[tuple], int]:
    """For each class, which ranks go to which windows: (class, from, to, times, first window), and the windows used."""
    rows, next_window, taken = [], 0, {}
    for repeats, combination in plan:
        for c in sorted(set(combination)):
            times = combination.count(c)
            begin = taken.get(c, 0)
            taken[c] = begin + repeats * times
            rows.append((c, begin, taken[c], times, next_window))
        next_window += repeats
    return rows, next_window


def pack_documents(
    docs: DataFrame, path: str = VOCABULARY, window: int = WINDOW, unit: int = UNIT, end_id: int = END_ID
) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text) into windows of ``window`` tokens.

    Returns one row per piece: doc_id, start and length (in the document's
    tokens), doc_tokens, sequence_id, offset (in the sequence, without gaps) and
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers). A null or
    empty text is the end id alone. Repeated rows are packed each; an empty table
    gives an empty table; other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/pieces-{uuid.uuid4().hex}"
    written = cut_pieces(docs, path, window, unit, end_id)
    written.write.option("compression", "zstd").parquet(folder)
    pieces = spark.read.schema(written.schema).parquet(folder)

    counts = materialise(pieces.groupBy("class", "task").agg(F.count("*").alias("n")))
    histogram = {r["class"]: r.n for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    rows, used = _slots(plan_windows(histogram, window // unit))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("class", "task", F.coalesce(before, F.lit(0)).alias("base"))

    # At most a few hundred rows: combinations in use times their lengths.
    slots = spark.createDataFrame(rows, "class int, begin long, until long, times long, first long")
    ranked = (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .select("doc_id", "start", "length", "doc_tokens", "class", "task", "rank", "row", "ids_crc32")
        .join(bases, ["class", "task"])
        .withColumn("rank", F.col("rank") + F.col("base"))
        .drop("base")
    )
    inside = (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("until"))
    placed = materialise(ranked.join(F.broadcast(slots.withColumnRenamed("class", "kind")), (F.col("class") == F.col("kind")) & inside, "left").drop("kind"))

    in_window = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "task", "row")
    filled = placed.filter("begin IS NOT NULL").withColumn(
        "sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("begin")) / F.col("times"))
    )
    filled = filled.withColumn(
        "offset", F.coalesce(F.sum("length").over(in_window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    return filled.select(*columns).unionByName(_poured(placed.filter("begin IS NULL"), pieces, used, window).select(*columns))


def _poured(rest: DataFrame, pieces: DataFrame, used: int, window: int) -> DataFrame:
    """Lay the remaining pieces end to end, and cut them where a window is full."""
    sums = rest.groupBy("task").agg(F.sum("length").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = sums.select("task", F.coalesce(before, F.lit(0)).alias("base"))
    so_far = F.sum("length").over(Window.partitionBy("task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    laid = (
        rest.select("doc_id", "start", "length", "doc_tokens", "task", "row", "ids_crc32")
        .withColumn("at", F.coalesce(so_far, F.lit(0)))
        .join(bases, "task")
        .withColumn("at", F.col("at") + F.col("base"))
        .withColumn("first", F.floor(F.col("at") / window))
        .withColumn("room", (F.col("first") + 1) * window - F.col("at"))
    )
    whole = laid.filter("length <= room").select(
        "doc_id", "start", "length", "doc_tokens", (F.col("first") + used).alias("sequence_id"), (F.col("at") % window).alias("offset"), "ids_crc32"
    )
    # One piece per window at most is cut; only those read their ids again.
    # Written first, so that its size is known before the pieces are joined.
    crossing = materialise(laid.filter("length > room").select("task", "row", "at", "first", "room")).join(
        pieces.select("doc_id", "start", "length", "doc_tokens", "task", "row", "ids"), ["task", "row"]
    )
    room = F.col("room").cast("int")
    parts = F.array(
        F.struct(
            F.col("start").alias("start"),
            F.col("room").alias("length"),
            (F.col("first") + used).alias("sequence_id"),
            (F.col("at") % window).alias("offset"),
            F.crc32(F.substring("ids", F.lit(1), room * 4)).alias("ids_crc32"),
        ),
        F.struct(
            (F.col("start") + F.col("room")).alias("start"),
            (F.col("length") - F.col("room")).alias("length"),
            (F.col("first") + used + 1).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
            F.crc32(F.substring("ids", room * 4 + 1, F.col("length").cast("int") * 4)).alias("ids_crc32"),
        ),
    )
    cut = crossing.select("doc_id", "doc_tokens", F.explode(parts).alias("part")).select("doc_id", "doc_tokens", "part.*")
    return whole.unionByName(cut)

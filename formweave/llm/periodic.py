"""Runs of words that repeat with a period of at least three times.

The words of several documents are numbered and laid end to end, each document closed
by a number of its own, so that no match leaves a document. How far two places agree (their longest
common extension) is answered from a difference cover: of every 21 places five are
sampled, and for any two places some shift below 21 brings both onto sampled ones. Only the sampled
suffixes are sorted, by their first 21 words and then by doubling; their common prefixes stand in
a sparse table for range minima. An extension compares the few words up to the
sampled places, then asks the table once.

A run of period q and at least three of them holds a point of any grid of step 2q (for small q, of
a step that the least length allows). So the pairs (i, i + q) over the grids of all q, a
harmonic sum in all, are extended to both sides, and what is long enough is a run.

A document is one row and one task's work; there is no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import batches

LEAST_LENGTH = 24
REPEATS = 3
# Documents are worked on together up to so many words, pairs of places up to so many at once.
BATCH_WORDS = 1 << 17
BATCH_PAIRS = 1 << 19

PERIOD = 21
COVER = np.array([0, 1, 4, 14, 16])
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_TYPE = "struct<start: long, length: long, period: long>"


def _shifts() -> np.ndarray:
    """[i mod 21, (j - i) mod 21] -> the least shift after which both places are sampled."""
    inside = np.isin(np.arange(PERIOD), COVER)
    out = np.full((PERIOD, PERIOD), -1)
    for i in range(PERIOD):
        for apart in range(PERIOD):
            out[i, apart] = next(s for s in range(PERIOD) if inside[(i + s) % PERIOD] and inside[(i + apart + s) % PERIOD])
    return out


_SHIFT = _shifts()
_SLOT = np.full(PERIOD, -1)
_SLOT[COVER] = np.arange(len(COVER))


class Extensions:
    """Longest common extensions of an array of numbers, which must end in a number of its own."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        top = int(values.max(initial=-1)) + 1
        # What stands behind the end is unlike anything, so that places near it need no care.
        self.values = np.concatenate([values, np.arange(top, top + 3 * PERIOD)])
        blocks = n // PERIOD + 1
        places = (np.arange(blocks)[:, None] * PERIOD + COVER).ravel()
        self._sort(places, self._names(places, top + 3 * PERIOD))

    def _names(self, places: np.ndarray, top: int) -> np.ndarray:
        """The rank of the 21 words from each place; equal words, equal rank."""
        bits = max(int(top).bit_length(), 1)
        each = max(62 // bits, 1)
        keys = []
        for a in range(0, PERIOD, each):
            key = np.zeros(len(places), np.int64)
            for j in range(a, min(a + each, PERIOD)):
                key = key << bits | self.values[places + j]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(places), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        return self._ranked(order, new)

    @staticmethod
    def _ranked(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Each element's rank: where its group of equals begins in the order."""
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        rank = np.empty(len(order), np.int64)
        rank[order] = first
        return rank

    def _sort(self, places: np.ndarray, rank: np.ndarray) -> None:
        m, step, levels = len(places), len(COVER), [rank]
        while True:
            size = np.bincount(rank, minlength=m)
            tied = np.flatnonzero(size[rank] > 1)
            if not len(tied):
                break
            # Ties are sorted by what follows; a group keeps its place in the order.
            after = rank[np.minimum(tied + step, m - 1)]
            order = np.lexsort([after, rank[tied]])
            group, follows = rank[tied][order], after[order]
            fresh = np.ones(len(tied), bool)
            fresh[1:] = group[1:] != group[:-1]
            begins = np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))
            fresh[1:] |= follows[1:] != follows[:-1]
            inner = np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0)) - begins
            rank = rank.copy()
            rank[tied[order]] = group + inner
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self.table = [self._common(places, order[:-1], order[1:], levels)]
        width = 1
        while 2 * width <= len(self.table[0]):
            low = self.table[-1]
            self.table.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def _common(self, places: np.ndarray, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of sampled suffixes that are neighbours in the order."""
        out, step, size = np.zeros(len(a), np.int64), len(COVER), len(places) - 1
        moved = np.zeros(len(a), np.int64)
        for level in reversed(range(len(levels))):
            rank = levels[level]
            same = rank[np.minimum(a + moved, size)] == rank[np.minimum(b + moved, size)]
            moved += same * (step << level)
        out += moved // step * PERIOD
        return out + self._compared(places[a] + out, places[b] + out, np.full(len(a), PERIOD))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from i and j, at most ``most``."""
        out = np.zeros(len(i), np.int64)
        active = np.flatnonzero(most > 0)
        while len(active):
            at = out[active]
            active = active[self.values[i[active] + at] == self.values[j[active] + at]]
            out[active] += 1
            active = active[out[active] < most[active]]
        return out

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common extension from each i and j, which differ."""
        shift = _SHIFT[i % PERIOD, (j - i) % PERIOD]
        out = self._compared(i, j, shift)
        far = np.flatnonzero(out == shift)
        if not len(far):
            return out
        a, b = i[far] + shift[far], j[far] + shift[far]
        a, b = (self.rank[p // PERIOD * len(COVER) + _SLOT[p % PERIOD]] for p in (a, b))
        low, wide = np.minimum(a, b), np.abs(a - b)
        level = np.frexp(wide.astype(float))[1] - 1
        least = np.empty(len(far), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            least[at] = np.minimum(row[low[at]], row[low[at] + wide[at] - (1 << int(k))])
        out[far] += least
        return out


def _pairs(starts: np.ndarray, lengths: np.ndarray, least: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places and periods, by blocks of bounded size, of all documents."""
    widest = lengths // repeats
    doc = np.repeat(np.arange(len(starts)), widest)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(widest) - widest, widest) + 1
    step = np.maximum((repeats - 1) * period, least - period)
    points = np.maximum(-(-(lengths[doc] - period) // step), 0)
    ends = np.cumsum(points)
    a = 0
    while a < len(doc):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_PAIRS, side="right")))
        n = points[a:b]
        which = np.repeat(np.arange(a, b), n)
        number = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield starts[doc[which]] + number * step[which], period[which]
        a = b


def find_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int = LEAST_LENGTH, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period.

    Documents stand in ``values`` at ``starts``, each followed by a number of its own.
    """
    n = len(values)
    lengths = np.where(lengths >= least, lengths, 0)
    found = []
    forward = backward = None
    for place, period in _pairs(starts, lengths, least, repeats):
        agree = values[place] == values[place + period]
        place, period = place[agree], period[agree]
        if not len(place):
            continue
        if forward is None:
            forward, backward = Extensions(values), Extensions(values[::-1])
        before = backward.of(n - place, n - place - period)
        length = before + forward.of(place, place + period) + period
        long_enough = length >= np.maximum(least, repeats * period)
        found.append(np.stack([place - before, length, period], 1)[long_enough])
    rows = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    # Of the periods of one stretch the smallest is the run's own; the others are its multiples.
    rows = rows[np.lexsort([rows[:, 2], rows[:, 1], rows[:, 0]])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort([rows[:, 2], rows[:, 0]])]


def _worked(texts: list[bytes], least: int, repeats: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """For each text its number of words, its runs, and the text without repeats."""
    words = [t.split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    numbers = defaultdict(count(len(texts)).__next__)  # below stand the ends of the documents
    values = np.empty(int(lengths.sum()) + len(texts), np.int64)
    for i, (w, a) in enumerate(zip(words, starts)):
        values[a : a + len(w)] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
        values[a + len(w)] = i
    runs = find_runs(values, starts, lengths, least, repeats)
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    cover = np.zeros(len(values) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(cover)[:-1] == 0
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, (w, a) in enumerate(zip(words, starts)):
        own = runs[bounds[i] : bounds[i + 1]]
        spans = [{"start": int(s - a), "length": int(m), "period": int(q)} for s, m, q in own]
        yield len(w), spans, b" ".join([w[k] for k in np.flatnonzero(kept[a : a + len(w)])] if spans else w)


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH, repeats: int = REPEATS) -> DataFrame:
    """The runs of every row of ``docs`` (doc_id, text), over whole texts.

    Words stand between ASCII white space. A run is a stretch with smallest period q, of at least
    ``least`` words and ``repeats`` periods, that no neighbouring word extends. Returns per row: doc_id,
    n_words, runs (start, length, period in words, by start, then period), and collapsed:
    the words joined by one space, without those that any run contains after its first period.

    A null text has no words, an empty one neither, and gives no runs and an empty collapsed
    text; a null doc_id stays null; repeated rows are worked on each; an empty table gives an
    empty table; other columns are not looked at. Very long texts are worked on alone,
    in memory that grows with their words.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])

    def work(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            texts = b.column(1).to_pylist()
            a, held = 0, 0
            for i, text in enumerate(texts):
                held += len(text) // 5 + 1
                if held >= BATCH_WORDS or i + 1 == len(texts):
                    rows = list(_worked(texts[a : i + 1], least, repeats))
                    columns = [pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(3)]
                    yield pa.record_batch([b.column(0)[a : i + 1].cast(pa.int64()), *columns], schema=schema)
                    a, held = i + 1, 0

    given = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    worked = given.mapInArrow(work, f"doc_id long, n_words long, runs array<{RUN_TYPE}>, collapsed binary")
    return worked.withColumn("collapsed", F.col("collapsed").cast("string"))

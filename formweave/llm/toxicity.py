"""Toxicity scores by a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of three rows of one hashed table, for the word and
for its first bytes (7 and 9), so inflected and compound words share rows, and a
chance collision of one hash is only a part of a match. Filters of several widths run over
the embeddings, each filter keeps its maximum over the text, and a logistic layer
reads the maxima. The table starts from the log-odds of its rows in the labelled
sample; all weights are then trained together (the gradient of a maximum reaches
one window per filter and text).

Training takes all labelled rows, where they lie: in each round every task descends over
its rows from the same model, and the changes are averaged on the executors, those of a table
row by how much the tasks learned about it. The starting counts, the score's curve and the
thresholds come from counts over all labelled rows too; only a model of fixed size passes the driver.
Scoring is one pass over all texts in Arrow batches, with no shuffle.
Thresholds can be set for each language from held-back rows; the language is no
input of the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import batches, remainder, whole_texts
from formweave.session import materialise

# Labelled rows that a task learns from in a round; more rows make more tasks.
SAMPLE_ROWS = 10_000
ROUNDS = 6
ROWS = 1 << 16
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
_BLOCK = 1 << 10  # table rows that are averaged together
_STEP_ROWS, _STEP_WORDS = 2_000, 400_000  # held at once by a task that learns
PARTS = (1 << 20, 9, 7)  # the bytes of a word that each of its rows is made from
_PAD = ROWS  # the row of zeros
_TABLE = bytes(c + 32 if 65 <= c <= 90 else (c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))
_MEMO = 200_000
_SENT_BYTES = 8 << 20  # rows of words that leave a task at once


class _Hashes(dict):
    """The table rows of a word, packed by 16 bits; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = 0
        for part in PARTS:
            value = value << 16 | zlib.crc32(word[:part], part) % ROWS
        if len(self) < _MEMO:
            self[word] = value
        return value


def _unpacked(packed: np.ndarray) -> np.ndarray:
    """Packed rows as (parts, words)."""
    shifts = np.array([16 * k for k in range(len(PARTS))], np.uint64)
    return ((packed[None] >> shifts[:, None]) & np.uint64(ROWS - 1)).astype(np.int64)


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def _rows_of(words: list[bytes], hashes: _Hashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def word_rows(text: str, hashes: _Hashes) -> np.ndarray:
    """The packed table rows of each word of a whole text."""
    return _rows_of(_words(text), hashes)


_SQUEEZED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("words", pa.binary())])


def squeezed(texts: DataFrame) -> DataFrame:
    """(doc_id, lang, words): the words of whole texts, compressed, of some two fifths of the texts' bytes."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(3).compress
        for b in batches(stream):
            words = [compress(b" ".join(_words(t))) for t in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0).cast(pa.int64()), b.column(1), pa.array(words, pa.binary())], schema=_SQUEEZED)

    return texts.select("doc_id", "lang", "text").mapInArrow(run, "doc_id long, lang string, words binary")


@dataclass
class Model:
    table: np.ndarray  # ROWS + 1 by SIZE
    filters: list[np.ndarray]  # for each width: width by SIZE by FILTERS
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all words of some texts (parts, words), padded between texts, and where texts start."""
    pad = max(WIDTHS) - 1
    lengths = np.array([len(t) + pad for t in texts])
    starts = np.append(0, np.cumsum(lengths))
    sides = np.full((len(PARTS), starts[-1]), _PAD, np.int64)
    for t, a in zip(texts, starts):
        sides[:, a : a + len(t)] = _unpacked(t)
    return sides, starts


def _embedded(model: Model, sides: np.ndarray) -> np.ndarray:
    words = model.table[sides[0]]
    for side in sides[1:]:
        words += model.table[side]
    return words


def _convolved(model: Model, words: np.ndarray) -> Iterator[np.ndarray]:
    """For each width the filters' response at every place."""
    n = len(words)
    for filters, shift, width in zip(model.filters, model.shifts, WIDTHS):
        out = np.zeros((n, FILTERS), np.float32)
        out += shift
        for j in range(width):
            out[: n - j] += words[j:] @ filters[j]
        yield out


def logits(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    sides, starts = _joined(texts)
    words = _embedded(model, sides)
    pooled = [np.maximum.reduceat(c, starts[:-1], axis=0) for c in _convolved(model, words)]
    return np.maximum(np.hstack(pooled), 0) @ model.out + model.bias


def scores(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    z = logits(model, texts).astype(float) * model.slope + model.offset
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _seen(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """In how many texts of either kind each table row occurs."""
    seen = np.zeros((2, ROWS))
    for t, y in zip(texts, toxic):
        seen[int(y), np.unique(_unpacked(t))] += 1
    return seen


def _start(seen: np.ndarray, others: int, toxic: int, random: np.random.Generator) -> Model:
    """Table rows start from their shrunk log-odds between toxic and other texts."""
    odds = np.log((seen[1] + 0.5) / (toxic + 1)) - np.log((seen[0] + 0.5) / (others + 1))
    total = seen.sum(0)
    table = random.normal(0, 0.02, (ROWS + 1, SIZE)).astype(np.float32)
    table[:-1, 0] += (odds * total / (total + 10)).astype(np.float32)
    table[_PAD] = 0
    filters = [random.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0, : FILTERS // 2] += 0.5
    shifts = [np.full(FILTERS, -0.5, np.float32) for _ in WIDTHS]
    return Model(table, filters, shifts, np.full(FILTERS * len(WIDTHS), 0.1, np.float32), -1.0)


@dataclass
class Descent:
    """A model in training, and the sums of its squared gradients."""

    model: Model
    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0

    @classmethod
    def of(cls, model: Model) -> Descent:
        zeros = np.zeros_like
        return cls(model, zeros(model.table), [zeros(f) for f in model.filters], [zeros(s) for s in model.shifts], zeros(model.out))

    def dense(self) -> np.ndarray:
        """All numbers but the table's."""
        m = self.model
        parts = (*m.filters, *m.shifts, m.out, *self.filters, *self.shifts, self.out, np.array([m.bias, self.bias]))
        return np.concatenate([p.astype(float).ravel() for p in parts])

    def move(self, change: np.ndarray) -> None:
        """Add to the numbers that dense() gives."""
        m, at = self.model, 0
        for part in (*m.filters, *m.shifts, m.out, *self.filters, *self.shifts, self.out):
            part += change[at : at + part.size].reshape(part.shape).astype(np.float32)
            at += part.size
        m.bias, self.bias = m.bias + float(change[at]), self.bias + float(change[at + 1])

    def learn(self, texts: list[np.ndarray], toxic: np.ndarray, order: np.ndarray, size: int = 32, rate: float = 0.02) -> None:
        """One pass over some texts in the given order."""
        model = self.model
        for a in range(0, len(order), size):
            chosen = order[a : a + size]
            sides, starts = _joined([texts[i] for i in chosen])
            words = _embedded(model, sides)
            at, top = [], []
            for c in _convolved(model, words):
                places = np.array([s + c[s:e].argmax(0) for s, e in zip(starts, starts[1:])])
                at.append(places)
                top.append(np.take_along_axis(c, places, 0))
            pooled = np.maximum(np.hstack(top), 0)
            error = (1 / (1 + np.exp(-(pooled @ model.out + model.bias))) - toxic[chosen]) / len(chosen)
            back = np.outer(error, model.out) * (pooled > 0)
            step = error @ pooled
            self.out += step * step
            model.out -= rate * step / (np.sqrt(self.out) + 1e-6)
            self.bias += error.sum() ** 2
            model.bias -= rate * error.sum() / (np.sqrt(self.bias) + 1e-6)
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                self.shifts[k] += g.sum(0) ** 2
                model.shifts[k] -= rate * g.sum(0) / (np.sqrt(self.shifts[k]) + 1e-6)
                change = np.zeros_like(model.filters[k])
                for j in range(width):
                    place = np.minimum(at[k] + j, len(words) - 1)
                    change[j] = np.einsum("bfd,bf->df", words[place], g)
                    spread = (g[:, :, None] * model.filters[k][j].T[None]).reshape(-1, SIZE)
                    for side in sides:
                        rows = side[place].ravel()
                        np.add.at(self.table, rows, spread * spread)
                        np.add.at(model.table, rows, -rate * spread / (np.sqrt(self.table[rows]) + 1e-6))
                    model.table[_PAD] = 0
                self.filters[k] += change * change
                model.filters[k] -= rate * change / (np.sqrt(self.filters[k]) + 1e-6)


def fit(texts: list[np.ndarray], toxic: np.ndarray, epochs: int = ROUNDS, size: int = 32, rate: float = 0.02) -> Model:
    """Train on packed word rows held here; texts of one kind only give an untrained model."""
    random = np.random.default_rng(11)
    model = _start(_seen(texts, toxic), int((~toxic).sum()), int(toxic.sum()), random)
    if not len(texts) or toxic.all() or not toxic.any():
        return model
    descent = Descent.of(model)
    for _ in range(epochs):
        descent.learn(texts, toxic, random.permutation(len(texts)), size, rate)
    return model


_CHANGE = pa.schema([("block", pa.int32()), ("rows", pa.float64()), ("moved", pa.binary()), ("learned", pa.binary())])
_CHANGE_SQL = "block int, rows double, moved binary, learned binary"


def _summed_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """_seen() over all rows (toxic, rows), and how many rows of either kind there are."""

    def count(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kinds = np.zeros((2, ROWS)), np.zeros(2)
        for b in batches(stream):
            toxic = b.column(0).to_numpy(zero_copy_only=False) == 1
            seen += _seen([np.frombuffer(r, np.uint64) for r in b.column(1).to_pylist()], toxic)
            kinds += np.bincount(toxic, minlength=2)
        if kinds.any():
            blocks = range(0, ROWS, _BLOCK)
            parts = [np.concatenate([seen[:, a : a + _BLOCK].ravel(), kinds]).tobytes() for a in blocks]
            yield pa.record_batch([pa.array([a // _BLOCK for a in blocks], pa.int32()), pa.array([0.0] * len(parts)), pa.array(parts, pa.binary()), pa.array([b""] * len(parts), pa.binary())], schema=_CHANGE)

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in t["moved"])
        return pa.table([t["block"][:1], t["rows"][:1], pa.array([total.tobytes()], pa.binary()), t["learned"][:1]], schema=_CHANGE)

    seen, kinds = np.zeros((2, ROWS)), np.zeros(2, int)
    for r in rows.select("toxic", "rows").mapInArrow(count, _CHANGE_SQL).groupBy("block").applyInArrow(add, _CHANGE_SQL).collect():
        numbers = np.frombuffer(r["moved"])
        seen[:, r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = numbers[:-2].reshape(2, -1)
        kinds = numbers[-2:].astype(int)
    return seen, kinds


def _round(rows: DataFrame, descent: Descent, number: int) -> None:
    """One round over all rows (toxic, rows): each task learns from its own, and the changes are averaged."""

    def learn(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = deepcopy(descent)
        random, taken = np.random.default_rng([number, TaskContext.get().partitionId()]), 0
        texts, toxic, words = [], [], 0

        def step() -> None:
            own.learn(texts, np.array(toxic), random.permutation(len(texts)))

        for b in batches(stream):
            for mark, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.append(np.frombuffer(packed, np.uint64))
                toxic.append(mark == 1)
                taken, words = taken + 1, words + len(texts[-1])
                if len(texts) >= _STEP_ROWS or words >= _STEP_WORDS:
                    step()
                    texts, toxic, words = [], [], 0
        if texts:
            step()
        if taken:
            moved, learned = own.model.table - descent.model.table, own.table - descent.table
            blocks = [a for a in range(0, ROWS, _BLOCK) if learned[a : a + _BLOCK].any()]
            cut = lambda v: [v[a : a + _BLOCK].astype(np.float32).tobytes() for a in blocks]
            dense = (own.dense() - descent.dense()).tobytes()
            at = pa.array([-1, *(a // _BLOCK for a in blocks)], pa.int32())
            yield pa.record_batch([at, pa.array([float(taken)] * len(at)), pa.array([dense, *cut(moved)], pa.binary()), pa.array([b"", *cut(learned)], pa.binary())], schema=_CHANGE)

    def average(t: pa.Table) -> pa.Table:
        counts = t["rows"].to_numpy()
        if t["block"][0].as_py() < 0:
            moved = sum(n * np.frombuffer(x.as_py()) for n, x in zip(counts, t["moved"])) / counts.sum()
            return pa.table([t["block"][:1], [counts.sum()], pa.array([moved.tobytes()], pa.binary()), t["learned"][:1]], schema=_CHANGE)
        total = moved = squares = np.float64(0)
        for x, y in zip(t["moved"], t["learned"]):
            learned = np.frombuffer(y.as_py(), np.float32).reshape(-1, SIZE).astype(float)
            weight = learned.sum(1, keepdims=True)
            total, squares = total + weight, squares + weight * learned
            moved = moved + weight * np.frombuffer(x.as_py(), np.float32).reshape(-1, SIZE)
        parts = [pa.array([(v / np.maximum(total, 1e-30)).astype(np.float32).tobytes()], pa.binary()) for v in (moved, squares)]
        return pa.table([t["block"][:1], [counts.sum()], *parts], schema=_CHANGE)

    changes = rows.select("toxic", "rows").mapInArrow(learn, _CHANGE_SQL).groupBy("block").applyInArrow(average, _CHANGE_SQL)
    for r in changes.collect():  # as many numbers as the model has
        if r["block"] < 0:
            descent.move(np.frombuffer(r["moved"]))
            continue
        part = slice(r["block"] * _BLOCK, (r["block"] + 1) * _BLOCK)
        descent.model.table[part] += np.frombuffer(r["moved"], np.float32).reshape(-1, SIZE)
        descent.table[part] += np.frombuffer(r["learned"], np.float32).reshape(-1, SIZE)


def calibrate(model: Model, texts: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray | None = None) -> None:
    """Fit the curve from logits to 0..1 on rows that the weights were not trained on.

    ``weight`` is the number of labelled rows that each row stands for.
    """
    if len(texts):
        z = np.concatenate([logits(model, texts[i : i + 64]) for i in range(0, len(texts), 64)]).astype(float)
        _calibrate(model, z, toxic, weight)


def _calibrate(model: Model, z: np.ndarray, toxic: np.ndarray, weight: np.ndarray | None) -> None:
    if toxic.all() or not toxic.any():
        return
    x = np.stack([z, np.ones(len(z))], 1)
    w = np.full(len(z), 1 / len(z)) if weight is None else weight / weight.sum()
    c, hold = np.array([1.0, 0.0]), np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -35, 35)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + hold
        change = np.linalg.solve(h, x.T @ (w * (p - toxic)) + hold @ (c - [1, 0]))
        c = c - change * min(1.0, 3.0 / max(np.abs(change).max(), 1e-12))
    model.slope, model.offset = max(float(c[0]), 1e-3), float(c[1])


def best_cut(score: np.ndarray, toxic: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The threshold with the best F1, rows counted by ``weight``; 0.5 where there is nothing to choose."""
    if not toxic.any() or toxic.all():
        return 0.5
    order = np.argsort(-score, kind="stable")
    w = np.ones(len(order)) if weight is None else weight[order]
    hits = np.cumsum(w * toxic[order])
    f1 = 2 * hits / (np.cumsum(w) + hits[-1])
    i = int(f1.argmax())
    after = score[order[i + 1]] if i + 1 < len(order) else 0.0
    return float((score[order[i]] + after) / 2)


def _back_logits(rows: DataFrame, model: Model) -> pd.DataFrame:
    """lang, toxic, z (logit in thousandths), n: the rows held back, counted."""
    schema = pa.schema([("lang", pa.string()), ("toxic", pa.int32()), ("z", pa.int32())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            texts = [np.frombuffer(r, np.uint64) for r in b.column(2).to_pylist()]
            z = np.concatenate([logits(model, texts[i : i + 64]) for i in range(0, len(texts), 64)])
            z = np.rint(np.clip(z, -100, 100).astype(float) * 1000).astype(np.int32)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(z)], schema=schema)

    counted = rows.select("lang", "toxic", "rows").mapInArrow(run, "lang string, toxic int, z int")
    return counted.groupBy("lang", "toxic", "z").agg(F.count("*").alias("n")).toPandas()


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, sample: int = SAMPLE_ROWS) -> tuple[Model, dict[str, float]]:
    """A calibrated model and its thresholds by language, from all labelled rows whose
    crc32(doc_id) modulo ``modulus`` is not 1; a fifth of them is held back for calibration.

    All rows are learned from in every round, ``sample`` of them by a task.
    """
    known = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Written, as it is counted and joined.
    known = materialise(known.filter((remainder("doc_id", modulus) != 1) & F.col("toxic").isin(0, 1)))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.filter((remainder("doc_id", modulus) != 1) & F.col("doc_id").isNotNull())
    texts = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"))
    # Texts go to the labels as compressed words, at any size: no table of labels has to fit a task.
    chosen = squeezed(texts).join(known.hint("merge"), "doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("lang", pa.string()), ("back", pa.bool_()), ("rows", pa.binary())])

    def hashed(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, decompress = _Hashes(), zstandard.ZstdDecompressor().decompress
        for b in batches(stream):
            ids, words = b.column(0).cast(pa.int64()), b.column(3)
            back = pa.array([zlib.crc32(b"back %d" % i) % 5 == 0 for i in ids.to_pylist()], pa.bool_())
            columns = [ids, b.column(1).cast(pa.int32()), b.column(2), back]
            rows, a, held = [], 0, 0
            for i in range(b.num_rows):  # a few compressed bytes can hold many words
                rows.append(_rows_of(decompress(words[i].as_py()).split(), hashes).tobytes())
                held += len(rows[-1])
                if held > _SENT_BYTES or i + 1 == b.num_rows:
                    yield pa.record_batch([*(c.slice(a, len(rows)) for c in columns), pa.array(rows, pa.binary())], schema=schema)
                    rows, a, held = [], i + 1, 0

    tasks = max(1, -(-known.count() // sample))
    rows = materialise(
        chosen.select("doc_id", "toxic", "lang", "words")
        .repartition(tasks, "doc_id")
        .mapInArrow(hashed, "doc_id long, toxic int, lang string, back boolean, rows binary")
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "rows")
    )
    learned = rows.filter("NOT back")
    seen, (others, toxic) = _summed_counts(learned)
    model = _start(seen, int(others), int(toxic), np.random.default_rng(11))
    if others and toxic:
        descent = Descent.of(model)
        for number in range(ROUNDS):
            _round(learned, descent, number)
    back = _back_logits(rows.filter("back"), model)
    z, marks, counts = back["z"].to_numpy(float) / 1000, back["toxic"].to_numpy(int) == 1, back["n"].to_numpy(float)
    if len(back):
        _calibrate(model, z, marks, counts)
    score = 1 / (1 + np.exp(-np.clip(z * model.slope + model.offset, -35, 35)))
    cuts = {}
    for name in sorted({n for n in back["lang"] if n is not None}):
        own = (back["lang"] == name).to_numpy()
        cuts[name] = best_cut(score[own], marks[own], counts[own])
    return model, cuts


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, over whole texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def scored(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches(stream):
            texts = [word_rows(t, hashes) for t in b.column(1).to_pylist()]
            out, a, held = [], 0, 0
            for i, t in enumerate(texts):  # a bounded number of words at once
                held += len(t)
                if held > 200_000 or i + 1 == len(texts):
                    out.append(scores(model, texts[a : i + 1]))
                    a, held = i + 1, 0
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(np.concatenate(out))], schema=schema)

    return whole_texts(docs).mapInArrow(scored, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3) -> tuple[DataFrame, dict[str, float]]:
    """Score every row of ``docs`` (doc_id, text, lang) by ``labels`` (doc_id, toxic 0/1).

    Returns (doc_id, held_out, score) with one row per row of ``docs``, and the
    thresholds by language. held_out rows (crc32 of the id modulo ``modulus`` is
    1) are never learned from. Null and empty texts are scored as texts without
    words; repeated rows get equal scores; null labels count as absent. Without
    labels of both kinds the scores come from an untrained model. An empty table
    gives an empty table; other columns are not looked at.
    """
    model, cuts = train(docs, labels, modulus)
    scored = score_texts(docs, model)
    return scored.select("doc_id", (remainder("doc_id", modulus) == 1).alias("held_out"), "score"), cuts

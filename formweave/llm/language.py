"""Language identification by a convolutional network over bytes, trained in numpy.

A text is cut into windows of a fixed number of bytes, the last one filled up with zeros. Each byte has
a short embedding; filters of several widths run over a window, each keeps its maximum, and
a softmax over the maxima gives the window's languages. A text's distribution is the mean
over all its windows, weighted by their bytes.

The network is fitted on the driver, on a bounded sample of labelled texts. Scoring is one pass over
all texts in Arrow batches, with no shuffle. A filter's response is a sum of one number per byte
value and offset, so embeddings and filters are multiplied out beforehand and looked up
by pairs of bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.common import batches, remainder

# Fitted on at most so many texts of each language, so many windows of each text,
# and the commonest languages if there are more than so many.
SAMPLE_TEXTS = 500
SAMPLE_WINDOWS = 8
LANGUAGES = 200
WINDOW = 128
SIZE, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
UNKNOWN = "und"
_AT_ONCE = 256  # windows
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts, one row each, and how many each text has (at least one)."""
    parts, counts = [], []
    for t in texts:
        n = max(1, -(-len(t) // WINDOW))
        parts += [t.translate(_LOWER), bytes(n * WINDOW - len(t))]
        counts.append(n)
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW), np.array(counts, np.int64)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 by SIZE
    filters: list[np.ndarray]  # for each width: width by SIZE by FILTERS
    shift: np.ndarray
    out: np.ndarray  # all filters by languages
    out_shift: np.ndarray

    def offsets(self) -> list[list[np.ndarray]]:
        """For each width and offset the response to each byte value: 256 by FILTERS."""
        return [[self.embedding @ f for f in filters] for filters in self.filters]

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.shift, 0) @ self.out + self.out_shift
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


class Scorer:
    """The network with its responses looked up by pairs of bytes, for widths 2, 3 and 4."""

    def __init__(self, network: Network):
        self.network = network
        two, three, four = network.offsets()
        pair = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, FILTERS)
        # A window shorter by the widest filter than it might be: all filters end within it.
        self.first = np.hstack([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])]).astype(np.float32)
        late = np.broadcast_to(three[2][:, None], (256, 256, FILTERS)).reshape(1 << 16, FILTERS)
        self.second = np.hstack([late, pair(four[2], four[3])]).astype(np.float32)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Each filter's maximum over each window."""
        pairs = rows[:, :-1].astype(np.uint16) << 8 | rows[:, 1:]
        n = WINDOW - max(WIDTHS) + 1
        out = np.empty((len(rows), self.first.shape[1]), np.float32)
        for a in range(0, len(rows), _AT_ONCE):
            part = pairs[a : a + _AT_ONCE]
            response = self.first[part[:, :n]]
            response[..., FILTERS:] += self.second[part[:, 2 : n + 2]]
            out[a : a + _AT_ONCE] = response.max(1)
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """The distribution over languages of each whole text."""
        rows, counts = windows(texts)
        p = self.network.probabilities(self.pooled(rows))
        weight = np.full(len(rows), float(WINDOW))
        last = np.cumsum(counts) - 1
        weight[last] = np.array([max(len(t), 1) for t in texts]) - (counts - 1) * WINDOW
        first = last - counts + 1
        return np.add.reduceat(p * weight[:, None], first, axis=0) / np.add.reduceat(weight, first)[:, None]


def _start(languages: list[str], random: np.random.Generator) -> Network:
    embedding = random.normal(0, 0.5, (256, SIZE))
    embedding[0] = 0
    filters = [random.normal(0, 1 / np.sqrt(w * SIZE), (w, SIZE, FILTERS)) for w in WIDTHS]
    total = FILTERS * len(WIDTHS)
    return Network(languages, embedding, filters, np.zeros(total), random.normal(0, 0.1, (total, len(languages))), np.zeros(len(languages)))


def fit(rows: np.ndarray, language: np.ndarray, languages: list[str], epochs: int = 6, size: int = 64, rate: float = 0.01) -> Network:
    """Train on windows; half of them are cut short at random, as short texts are."""
    random = np.random.default_rng(13)
    network = _start(languages, random)
    if len(rows) == 0 or len(languages) < 2:
        return network
    values = [network.embedding, *network.filters, network.shift, network.out, network.out_shift]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    n, t = WINDOW - max(WIDTHS) + 1, 0
    for epoch in range(epochs):
        order = random.permutation(len(rows))
        for a in range(0, len(order), size):
            at = order[a : a + size]
            x = rows[at].astype(np.int64)
            ends = np.where(random.random(len(at)) < 0.5, random.integers(6, WINDOW + 1, len(at)), WINDOW)
            x[np.arange(WINDOW) >= ends[:, None]] = 0
            offsets = network.offsets()
            places, pooled = [], []
            for tables in offsets:
                response = tables[0][x[:, :n]]
                for j, table in enumerate(tables[1:], 1):
                    response += table[x[:, j : j + n]]
                where = response.argmax(1)
                places.append(where)
                pooled.append(np.take_along_axis(response, where[:, None], 1)[:, 0])
            pooled = np.hstack(pooled)
            hidden = np.maximum(pooled + network.shift, 0)
            error = network.probabilities(pooled)
            error[np.arange(len(at)), language[at]] -= 1
            error /= len(at)
            back = (error @ network.out.T) * (hidden > 0)
            changes = [np.zeros_like(network.embedding)]
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                change = np.zeros_like(network.filters[k])
                for j in range(width):
                    byte = np.take_along_axis(x, places[k] + j, 1)  # the byte under each filter's maximum
                    cell = (byte * FILTERS + np.arange(FILTERS)).ravel()
                    table = np.bincount(cell, g.ravel(), 256 * FILTERS).reshape(256, FILTERS)
                    change[j] = network.embedding.T @ table
                    changes[0] += table @ network.filters[k][j].T
                changes.append(change)
            changes += [back.sum(0), hidden.T @ error, error.sum(0)]
            t += 1
            for v, m, s, g in zip(values, first, second, changes):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= rate * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
            network.embedding[0] = 0
    return network


def train(docs: DataFrame, modulus: int = 5, sample: int = SAMPLE_TEXTS) -> Network:
    """A network from rows with a language whose crc32(doc_id) modulo ``modulus`` is not 0."""
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    known = known.filter(F.col("lang").isNotNull() & (remainder("doc_id", modulus) != 0) & F.col("text").rlike("\\p{L}"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return _start([], np.random.default_rng(0))
    # Only rows with a small hash are looked at: a few times the wanted number of each language.
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, 4 * sample / r["count"]))])
    hashed = known.withColumn("hash", F.xxhash64("doc_id", "text"))
    near = hashed.filter(F.pmod("hash", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    order = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1 << 30)), "hash", "doc_id")
    chosen = near.dropDuplicates(["lang", "doc_id", "hash"]).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= sample)
    schema = pa.schema([("lang", pa.string()), ("hash", pa.int64()), ("windows", pa.binary())])

    def cut(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            out = []
            for text in b.column(2).to_pylist():
                rows, _ = windows([text])
                pick = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), SAMPLE_WINDOWS)).astype(int))
                out.append(rows[pick].tobytes())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.binary())], schema=schema)

    taken = chosen.select("lang", "hash", F.col("text").cast("binary").alias("text")).mapInArrow(cut, "lang string, hash long, windows binary")
    rows = sorted(taken.toArrow().to_pylist(), key=lambda r: (r["lang"], r["hash"]))
    cuts = [np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in rows]
    label = np.repeat([languages.index(r["lang"]) for r in rows], [len(c) for c in cuts])
    return fit(np.concatenate(cuts), label, languages)


def predict_language(docs: DataFrame, modulus: int = 5, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """The language of every row of ``docs`` (doc_id, text, lang), from whole texts.

    Returns per row: doc_id, held_out (crc32 of the id modulo ``modulus`` is 0; such rows are
    never learned from), lang_pred and its probability score. Only doc_id, text and lang are
    looked at, and lang only to learn. A text that is null or without letters, an empty one
    included, is ``und`` with score 0; so is every text where no language is known.
    Repeated rows get equal results; a null doc_id counts as held out; an
    empty table gives an empty table.
    """
    network = train(docs, modulus, sample)
    languages = [*network.languages, UNKNOWN]
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def score(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network) if network.languages else None
        for b in batches(stream):
            texts = b.column(1).to_pylist()
            best, top = np.full(len(texts), len(languages) - 1), np.zeros(len(texts))
            asked = np.flatnonzero(b.column(2).to_numpy(zero_copy_only=False)) if scorer else []
            a, held = 0, 0
            for i, k in enumerate(asked):  # a bounded number of bytes at once
                held += len(texts[k])
                if held > 1 << 20 or i + 1 == len(asked):
                    part = asked[a : i + 1]
                    p = scorer.texts([texts[j] for j in part])
                    best[part], top[part] = p.argmax(1), p.max(1)
                    a, held = i + 1, 0
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array([languages[k] for k in best]), pa.array(np.clip(top, 0, 1))], schema=schema)

    text = F.coalesce("text", F.lit(""))
    given = docs.select("doc_id", text.cast("binary").alias("text"), text.rlike("\\p{L}").alias("letters"))
    found = given.mapInArrow(score, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", modulus) == 0).alias("held_out"), "lang_pred", "score")

"""Quality scores by Bradley-Terry pairwise ranking.

Each text becomes a short vector of surface measures, computed once per row in
Arrow batches. A linear score is learned from preference pairs (one text of good
and one of bad quality) by logistic loss on the difference of their vectors. The
score only orders texts; a logistic curve fitted on the same labelled rows maps
it to 0..1, and a threshold can be set at any quantile of the scores of the
whole corpus.

Only the vectors of a bounded sample of labelled rows come to the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.llm.common import batches, release, remainder, whole_texts
from formweave.session import materialise

# The classifier is fitted on at most this many labelled rows, and pairs.
SAMPLE_ROWS = 20_000
PAIRS = 100_000
_UPPER, _LOWER, _DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_MARKS = b"!?#*|<>{}[]=_/\\~^$%&@+"
_FEATURES = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("features", pa.list_(pa.float64()))])
WIDTH = 15


def measures(text: str) -> list[float]:
    """Surface measures of one whole text: lengths, repetition, case, marks."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n, size = max(len(words), 1), max(len(data), 1)
    counts = Counter(words)
    lines = data.split(b"\n")
    share = lambda kept: (len(data) - len(data.translate(None, kept))) / size
    upper, lower = share(_UPPER), share(_LOWER)
    return [
        min(np.log1p(len(words)), 6.0),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        size / n if words else 0.0,
        upper,
        upper / max(upper + lower, 1e-9),
        share(_DIGIT),
        share(b"!"),
        share(b"|"),
        share(_MARKS),
        share(b".,;:"),
        len(set(lines)) / len(lines),
        len(lines) / n,
        len(zlib.compress(data, 1)) / size,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, key, features) of every row; the key is a hash of the text."""

    def compute(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            rows = [measures(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(rows, _FEATURES.field(2).type)], schema=_FEATURES)

    keyed = whole_texts(docs).withColumn("key", F.xxhash64("text"))
    return keyed.mapInArrow(compute, "doc_id long, key long, features array<double>")


@dataclass
class Ranker:
    """Squared and plain standardised measures, weights, and the curve to 0..1."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def expand(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.centre) / self.scale, -6, 6)
        return np.hstack([z, z * z])

    def score(self, features: str = "features") -> Column:
        """The score of a column of measures, as one expression."""
        terms = []
        for i in range(len(self.centre)):
            z = (F.col(features)[i] - float(self.centre[i])) / float(self.scale[i])
            z = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), z))
            terms.append(z * float(self.weights[i]) + z * z * float(self.weights[i + len(self.centre)]))
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total * self.slope + self.offset)))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_ranker(rows: np.ndarray, good: np.ndarray, pairs: int = PAIRS, steps: int = 60, ridge: float = 1e-3) -> Ranker:
    """Fit on vectors and their labels; without both labels the score is a constant.

    The loss is convex: Newton steps on all pairs at once. The pairs are drawn
    with a fixed seed, so equal samples give equal rankers.
    """
    width = rows.shape[1] if len(rows) else WIDTH
    model = Ranker(np.zeros(width), np.ones(width), np.zeros(2 * width), 1.0, 0.0)
    share = float(good.mean()) if len(good) else 0.5
    if not len(good) or not 0 < share < 1:
        model.offset = float(np.log((share * len(good) + 1) / ((1 - share) * len(good) + 1)))
        return model
    model.centre, model.scale = rows.mean(0), rows.std(0) + 1e-6
    x = model.expand(rows)
    random = np.random.default_rng(7)
    winners = random.choice(np.flatnonzero(good), pairs)
    losers = random.choice(np.flatnonzero(~good), pairs)
    w = np.zeros(x.shape[1])
    step = 16_384
    for _ in range(steps):
        gradient, curve = ridge * w, ridge * np.eye(len(w))
        for a in range(0, pairs, step):
            d = x[winners[a : a + step]] - x[losers[a : a + step]]
            p = _logistic(d @ w)
            gradient = gradient - d.T @ (1 - p) / pairs
            curve = curve + (d * (p * (1 - p))[:, None]).T @ d / pairs
        change = np.linalg.solve(curve, gradient)
        change *= min(1.0, 2.0 / max(np.abs(change).max(), 1e-12))
        w = w - change
        if np.abs(change).max() < 1e-4:
            break
    model.weights = w
    model.slope, model.offset = _curve(x @ w, good)
    return model


def _curve(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from scores to labels, lightly held back."""
    spread = score.std() + 1e-9
    z = np.stack([score / spread, np.ones(len(score))], 1)
    c = np.zeros(2)
    hold = np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = _logistic(z @ c)
        h = (z * (p * (1 - p))[:, None]).T @ z / len(z) + hold
        change = np.linalg.solve(h, z.T @ (p - good) / len(z) + hold @ c)
        c = c - change * min(1.0, 3.0 / max(np.abs(change).max(), 1e-12))
    return float(c[0] / spread), float(c[1])


def score_quality(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, sample: int = SAMPLE_ROWS, with_key: bool = False
) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by ``labels`` (doc_id, quality 0/1).

    Returns per row: doc_id, held_out (crc32 of the id modulo ``modulus`` is 0;
    such rows are never learned from), score (0..1, higher is better), and on
    request key (xxhash64 of the text, telling rows of one id apart). Null and
    empty texts are scored as empty ones; repeated rows get equal scores; labels
    that are null count as absent. Without labels of both kinds all scores are
    equal. An empty table gives an empty table; other columns are not looked at.
    """
    vectors = materialise(measured(docs))
    # At most ``sample`` ids: small enough to send to every task.
    model = _fitted(vectors.join(F.broadcast(_labelled(labels, modulus, sample)), "doc_id"), sample)
    key = ["key"] if with_key else []
    return vectors.select("doc_id", *key, (remainder("doc_id", modulus) == 0).alias("held_out"), model.score().alias("score"))


def _labelled(labels: DataFrame, modulus: int, sample: int) -> DataFrame:
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return known.filter(remainder("doc_id", modulus) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def _fitted(learned: DataFrame, sample: int) -> Ranker:
    """A ranker of labelled rows (doc_id, key, features, quality); of one id and text one counts."""
    learned = learned.select("doc_id", "key", "features", "quality").dropDuplicates(["doc_id", "key"])
    # An id may stand on many rows of different texts; the bound holds for rows.
    rows = learned.orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key").limit(sample).toPandas()
    rows = rows.sort_values(["doc_id", "key"], kind="stable")
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), WIDTH)
    return fit_ranker(x, rows["quality"].to_numpy(int) == 1)


def keep_quality(docs: DataFrame, labels: DataFrame, cut: float, modulus: int = 5, sample: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that score_quality() scores at least ``cut``, with all their columns.

    Only labelled rows are measured before; then one pass measures, scores and filters where the
    rows lie, without a shuffle. Nulls, empty tables and repeats as in score_quality().
    """
    known = F.broadcast(_labelled(labels, modulus, sample))
    model = _fitted(measured(docs.select("doc_id", "text").join(known.select("doc_id"), "doc_id")).join(known, "doc_id"), sample)
    helper = "features"
    while helper in docs.columns:
        helper += "_"
    columns = [docs[f"`{c}`"] for c in docs.columns]
    given = docs.select(*columns, F.coalesce("text", F.lit("")).cast("string").alias(helper))
    at = len(columns)

    def compute(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches(stream):
            rows = pa.array([measures(t) for t in batch.column(at).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], rows], names=batch.schema.names)

    schema = T.StructType([*docs.schema.fields, T.StructField(helper, T.ArrayType(T.DoubleType()))])
    return given.mapInArrow(compute, schema).filter(model.score(helper) >= cut).select(*[F.col(f"`{c}`") for c in docs.columns])


def above_quantile(scored: DataFrame, quantile: float) -> DataFrame:
    """The rows whose score is at least the given quantile of all scores."""
    cut = scored.agg(F.percentile_approx("score", quantile, 100_000).alias("cut"))
    return scored.crossJoin(F.broadcast(cut)).filter(F.col("score") >= F.col("cut")).drop("cut")

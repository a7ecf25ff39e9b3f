"""Approximate nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is built and cut into balanced
parts, so that neighbours tend to share a part. A small network learns to tell
a vector's part. It then routes every vector to its most probable part, and every
query to its several most probable ones; how many, is the smallest number that
reaches the wanted recall for sample vectors held back from fitting. A query whose
parts hold too few rows visits further ones. Within the routed parts the search is exact.

The number of parts follows the square root of the number of vectors. One network tells
up to MAX_PARTS parts; beyond that each of these is cut again, on a bounded sample of its own
vectors, by a network of its own, fitted on the executors. Both networks' probabilities
multiplied order the parts for a query.

All vectors are indexed. A part is dealt into blocks of bounded size by the hash
of the id, so a part that holds most of the vectors, or most of their copies, is many
blocks. A task multiplies one block with a block of queries and keeps each
query's best; only those are shuffled again.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.common import batches
from formweave.session import materialise

# The network is fitted on at most this many vectors.
SAMPLE_ROWS = 16_384
# Parts that one network tells, and the vectors on which each network of the second level is fitted.
MAX_PARTS = 256
BELOW_ROWS = 4096
# Probabilities of parts that are held at once.
HELD = 4 << 20
BLOCK, QUERY_BLOCK = 8192, 512
_ROUTED = pa.schema([("part", pa.int32()), ("id", pa.int64()), ("vector", pa.binary())])
_PACKED = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
_FITTED = pa.schema([("part", pa.int32()), ("network", pa.binary())])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(ids: pa.Array, vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in double precision, without those that take no part: of a
    null id, null, zero, of another length, or holding null or non-finite values."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = (lengths == size) & ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    mask = pa.array(fits)
    rows = vectors.filter(mask).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    rows = rows.reshape(-1, size) if size else np.zeros((int(fits.sum()), 0))
    keep = np.isfinite(rows).all(1) & (rows != 0).any(1)
    return ids.filter(mask).to_numpy(zero_copy_only=False).astype(np.int64)[keep], rows[keep]


def neighbour_graph(rows: np.ndarray, k: int = 10) -> np.ndarray:
    """For each row its k nearest others by inner product."""
    k = min(k, len(rows) - 1)
    out = np.empty((len(rows), k), np.int64)
    for a in range(0, len(rows), 1024):
        s = rows[a : a + 1024] @ rows.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, passes: int = 12, slack: float = 1.1) -> np.ndarray:
    """Cut the graph into parts of at most ``slack`` times the mean size.

    Starts from rows dealt to the nearest of ``parts`` spread rows, within the
    size limit; then each row moves to the part of most of its neighbours while that part has room.
    """
    n = len(rows)
    random = np.random.default_rng(5)
    limit = math.ceil(slack * n / parts)
    near = rows @ rows[random.choice(n, parts, replace=False)].T
    part, filled = np.full(n, -1), np.zeros(parts, int)
    for i in np.argsort(-near.max(1), kind="stable"):
        for p in np.argsort(-near[i], kind="stable"):
            if filled[p] < limit:
                part[i], filled[p] = p, filled[p] + 1
                break
    back = [[] for _ in range(n)]
    for i, others in enumerate(graph):
        for j in others:
            back[j].append(i)
    around = [np.concatenate([graph[i], np.array(back[i], np.int64)]) for i in range(n)]
    for _ in range(passes):
        moved = 0
        for i in random.permutation(n):
            votes = np.bincount(part[around[i]], minlength=parts).astype(float)
            votes[filled >= limit] -= n * 10
            best = int(votes.argmax())
            if best != part[i] and votes[best] > np.count_nonzero(part[around[i]] == part[i]):
                filled[part[i]] -= 1
                filled[best] += 1
                part[i] = best
                moved += 1
        if moved < n / 200:
            break
    return part


@dataclass
class Router:
    """A network with one hidden layer, and how many parts a query should visit."""

    hidden: np.ndarray
    hidden_shift: np.ndarray
    out: np.ndarray
    out_shift: np.ndarray
    scale: float
    visits: int = 1

    @property
    def parts(self) -> int:
        return len(self.out_shift)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(rows * self.scale @ self.hidden + self.hidden_shift, 0) @ self.out + self.out_shift

    def best(self, rows: np.ndarray, visits: int) -> np.ndarray:
        return np.argsort(-self.logits(rows), axis=1, kind="stable")[:, :visits]

    def home(self, rows: np.ndarray) -> np.ndarray:
        return self.logits(rows).argmax(1)


def _log_shares(logits: np.ndarray) -> np.ndarray:
    z = logits - logits.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Tree(Router):
    """A router whose parts are cut again, each by a router of its own; parts are numbered one part after another."""

    below: list[Router] = field(default_factory=list)

    @property
    def parts(self) -> int:
        return sum(r.parts for r in self.below)

    def home(self, rows: np.ndarray) -> np.ndarray:
        """The likeliest part of the likeliest part of the first level."""
        first = np.cumsum([0, *(r.parts for r in self.below)])
        top = super().logits(rows).argmax(1)
        out = np.empty(len(rows), np.int64)
        for p in np.unique(top):
            out[top == p] = first[p] + self.below[p].home(rows[top == p])
        return out

    def logits(self, rows: np.ndarray) -> np.ndarray:
        top = _log_shares(super().logits(rows))
        return np.hstack([top[:, p : p + 1] + _log_shares(r.logits(rows)) for p, r in enumerate(self.below)])


def fit_router(rows: np.ndarray, part: np.ndarray, parts: int, epochs: int = 40, width: int = 128) -> Router:
    random = np.random.default_rng(9)
    size = rows.shape[1]
    scale = 1 / (np.sqrt((rows * rows).sum(1).mean() / max(size, 1)) + 1e-12)
    values = [random.normal(0, (1 / size) ** 0.5, (size, width)), np.zeros(width), random.normal(0, 0.05, (width, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    x, t = rows * scale, 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        order = random.permutation(len(x))
        for a in range(0, len(order), 256):
            at = order[a : a + 256]
            h = np.maximum(x[at] @ values[0] + values[1], 0)
            z = h @ values[2] + values[3]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(at)), part[at]] -= 1
            p /= len(at)
            d = (p @ values[2].T) * (h > 0)
            t += 1
            for v, m, s, g in zip(values, first, second, (x[at].T @ d + 1e-4 * values[0], d.sum(0), h.T @ p, p.sum(0))):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Router(*values, scale)


def _undivided(size: int) -> Router:
    return Router(np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1.0)


def _held_back(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A quarter of the sample, by which visits are measured, and the rest, on which is fitted."""
    held, fitted = np.split(np.random.default_rng(1).permutation(len(rows)), [len(rows) // 4])
    return held, fitted


def visits_for(router: Router, rows: np.ndarray, k: int, recall: float) -> int:
    """How many parts a query must visit to reach the recall for sample vectors held back from fitting."""
    home = router.home(rows)
    asked = _held_back(rows)[0][:1024]
    s = rows[asked] @ rows.T
    s[np.arange(len(asked)), asked] = -np.inf
    nearest = np.argpartition(-s, k - 1, axis=1)[:, :k]
    order = np.argsort(router.best(rows[asked], router.parts), axis=1)  # the visit at which each part is reached
    visit = np.take_along_axis(order, home[nearest], 1)
    return next(v for v in range(1, router.parts + 1) if (visit < v).mean() >= recall or v == router.parts)


def learn_partitions(rows: np.ndarray, parts: int, k: int, recall: float) -> Router:
    """Fit a router on three quarters of the sample; its visits reach the recall for the rest."""
    fitted = _held_back(rows)[1]
    parts = max(1, min(parts, len(fitted) // 16))
    if parts == 1 or len(rows) <= 4 * k:
        return _undivided(rows.shape[1])
    part = balanced_parts(rows[fitted], neighbour_graph(rows[fitted]), parts)
    router = fit_router(rows[fitted], part, parts)
    router.visits = visits_for(router, rows, k, recall)
    return router


def learn_below(vectors: DataFrame, router: Router, size: int, split: int, total: int, asked: np.ndarray) -> Tree:
    """Cut every part of ``router`` in about ``split``, each on at most BELOW_ROWS of its vectors.

    The vectors are taken by a hash of their ids, equal ones once; a part that still has more
    than twice what is fitted on is thinned by a hash, so no group grows with the table.
    Rows of ``asked``, by which visits are measured, are not among them.
    """
    unseen = {r.tobytes() for r in asked}

    def cut(rows: pa.Table) -> pa.Table:
        vectors = np.frombuffer(b"".join(sorted({v for v in rows["vector"].to_pylist()} - unseen))).reshape(-1, size)
        vectors = vectors[np.random.default_rng(3).permutation(len(vectors))[:BELOW_ROWS]]
        parts = min(split, len(vectors) // 16)
        network = fit_router(vectors, balanced_parts(vectors, neighbour_graph(vectors), parts), parts) if parts > 1 else _undivided(size)
        return pa.table([pa.array([rows["part"][0].as_py()], pa.int32()), pa.array([pickle.dumps(network)], pa.binary())], schema=_FITTED)

    every = max(1, total // (2 * BELOW_ROWS * router.parts))
    taken = vectors.filter(F.pmod(F.xxhash64("vec_id", F.lit("below")), F.lit(every)) == 0)
    different = materialise(_homes(taken, router, size).select("part", "vector").distinct())
    thinner = _blocks({r.part: r["count"] for r in different.groupBy("part").count().collect()} or {0: 1}, 2 * BELOW_ROWS)
    thinned = different.filter(F.pmod(F.xxhash64("vector", F.lit("thin")), thinner) == 0)
    fitted = thinned.groupBy("part").applyInArrow(cut, "part int, network binary")
    networks = {r.part: pickle.loads(r.network) for r in fitted.collect()}  # one for each part of the first level
    below = [networks.get(p) or _undivided(size) for p in range(router.parts)]
    return Tree(router.hidden, router.hidden_shift, router.out, router.out_shift, router.scale, below=below)


def _homes(vectors: DataFrame, router: Router, size: int) -> DataFrame:
    """Every usable vector with its most probable part."""

    def route(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            ids, rows = usable(b.column(0).cast(pa.int64()), b.column(1), size)
            if len(ids):
                part = router.home(rows).astype(np.int32)
                yield pa.record_batch([pa.array(part), pa.array(ids), pa.array([r.tobytes() for r in rows], pa.binary())], schema=_ROUTED)

    return vectors.mapInArrow(route, "part int, id long, vector binary")


def parts_to_visit(router: Router, rows: np.ndarray, held: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, part) pairs: each row's most probable parts, as many as the router visits,
    and further ones until they hold ``least`` vectors (all parts if they hold fewer)."""
    best = router.best(rows, router.parts)
    before = np.cumsum(held[best], axis=1) - held[best]
    wanted = (np.arange(router.parts) < router.visits) | (before < least)
    row, place = np.nonzero(wanted & (held[best] > 0))
    return row, best[row, place]


def _visits(homes: DataFrame, router: Router, size: int, held: np.ndarray, least: int) -> DataFrame:
    """The queries, once for every part that they visit."""

    def route(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            step = max(1, HELD // router.parts)
            for some in (b.slice(a, step) for a in range(0, b.num_rows, step)):
                data = some.column(2).to_pylist()
                row, part = parts_to_visit(router, np.frombuffer(b"".join(data)).reshape(-1, size), held, least)
                ids = some.column(1).to_numpy()[row]
                yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(ids), pa.array([data[i] for i in row], pa.binary())], schema=_ROUTED)

    return homes.mapInArrow(route, "part int, id long, vector binary")


def _blocks(counts: dict[int, int], block: int) -> Column:
    """The number of blocks of a row's part."""
    sizes = [math.ceil(counts.get(p, 0) / block) for p in range(max(counts) + 1)]
    return F.element_at(F.lit(sizes), F.col("part") + 1)


def _packed(routed: DataFrame, block: int, counts: dict[int, int]) -> DataFrame:
    """Blocks of about ``block`` rows of the same part: (part, block, ids, vectors)."""

    def pack(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        vectors = rows["vector"].to_pylist()
        key = [[rows[c][0].as_py()] for c in ("part", "block")]
        return pa.table([*key, [ids[order].tobytes()], [b"".join(vectors[i] for i in order)]], schema=_PACKED)

    numbered = routed.select("part", F.pmod(F.xxhash64("id"), _blocks(counts, block)).cast("int").alias("block"), "id", "vector")
    return numbered.groupBy("part", "block").applyInArrow(pack, "part int, block int, ids binary, vectors binary")


def best_of_block(queries: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, ids, scores) of each query's k nearest in one block.

    The product only selects; scores are summed again in one fixed order, so that
    equal vectors tie exactly wherever they stand.
    """
    product = asked @ rows.T
    margin = 1e-9 * (1 + np.abs(product).max(initial=0))
    for q, vector, near in zip(queries, asked, product):
        own = ids != q
        near = np.where(own, near, -np.inf)
        keep = own if own.sum() <= k else own & (near >= np.partition(near, -k)[-k] - margin)
        at = np.flatnonzero(keep)
        score = (rows[at] * vector).sum(1)
        order = np.lexsort((ids[at], -score))[:k]
        yield int(q), ids[at][order], score[order]


def nearest(
    vectors: DataFrame,
    k: int = 20,
    step: int = 20,
    recall: float = 0.95,
    sample: int = SAMPLE_ROWS,
    parts: int | None = None,
    most: int = MAX_PARTS,
) -> DataFrame:
    """The k nearest rows by inner product of every row whose id is divisible by ``step``.

    ``vectors``: (vec_id, embedding). Returns (query_id, rank from 1, vec_id,
    score), nearest first, ties to the smaller vec_id; all candidates where there
    are fewer than k. Rows of the query's own id are no candidates; other rows
    with equal vectors are, each. Vectors null, zero, with null or non-finite components, of
    another length than most, or without an id take no part. An empty
    table gives an empty table; other columns are not looked at. ``parts`` fixes the
    number of parts, which otherwise follows the number of vectors; above ``most``, parts are cut again.
    """
    given = vectors.select("vec_id", "embedding")
    sizes = given.groupBy(F.size("embedding").alias("size")).count().filter("size > 0").orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    total = sizes["count"] if sizes else 0
    parts = parts or 1 << max(0, round(math.log2(max(1.0, math.sqrt(total) / 14))))
    taken = given.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(sample, max(4096, 64 * parts))).toArrow().combine_chunks()
    column = lambda n: taken[n].combine_chunks() if taken.num_rows else pa.array([], taken.schema.field(n).type)
    _, rows = usable(column("vec_id").cast(pa.int64()), column("embedding"), size)
    router = learn_partitions(rows, min(parts, most), k, recall)
    if router.parts > 1 and parts > most:
        router = learn_below(given, router, size, math.ceil(parts / most), total, rows[_held_back(rows)[0][:1024]])
        router.visits = visits_for(router, rows, k, recall)

    homes = materialise(_homes(given, router, size))
    count = lambda d: {r.part: r["count"] for r in d.groupBy("part").count().collect()} or {0: 1}  # noqa: E731  a row for each part
    held = count(homes)
    stored = _packed(homes, BLOCK, held)
    queries = homes.filter(F.pmod("id", F.lit(step)) == 0)
    # Rows of the query's own id are no candidates: that many more are needed.
    own = queries.groupBy("id").count().agg(F.max("count")).first()[0] or 1
    sizes = np.array([held.get(p, 0) for p in range(router.parts)])
    asked = materialise(_visits(queries, router, size, sizes, k + own))
    asked = _packed(asked, QUERY_BLOCK, count(asked)).select("part", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), _blocks(held, BLOCK) - 1)))

    def search(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            for q_ids, q_rows, ids, rows in zip(*(b.column(i).to_pylist() for i in range(4))):
                out = list(
                    best_of_block(
                        np.frombuffer(q_ids, np.int64),
                        np.frombuffer(q_rows).reshape(-1, size),
                        np.frombuffer(ids, np.int64),
                        np.frombuffer(rows).reshape(-1, size),
                        k,
                    )
                )
                query = np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]).astype(np.int64)
                yield pa.record_batch([query, np.concatenate([i for _, i, _ in out]), np.concatenate([s for _, _, s in out])], schema=_FOUND)

    pairs = asked.join(stored, ["part", "block"]).select("q_ids", "q_vectors", "ids", "vectors")
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

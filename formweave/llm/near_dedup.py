"""Near-duplicate classes by Order MinHash.

A text is its words (lower case, punctuation dropped) and their shingles of five;
the n-th occurrence of a shingle carries the label n. A table of the sketch takes
the least-hashed labelled shingles and keeps them in text order: two
texts share its signature only if those shingles agree and stand in the same
order, so the sketch follows edit similarity, not only common words.

Texts sharing a signature are candidates. A candidate pair is verified by banded
alignment: labelled shingles are matched and the longest chain running in both
texts' order is found, within the band that the wanted similarity leaves. With A
matches between texts of m and n shingles the similarity is A / (m + n - A).

Pairs of a bucket are not all emitted. Each bucket is compared with its first
member, then with some random ones, and verified links join components. For
buckets that still hold several components, their texts' rarest shingles give the remaining
candidates, by a bound that loses none. A coarse histogram of shingles bounds
the similarity from above, exactly, so that most pairs that fail never move a text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import batches
from formweave.session import materialise

SHINGLE, SIMILARITY = 5, 0.8
# At similarity 0.8 a pair shares no signature with a chance of about 1e-5.
TABLES, PICKS = 16, 3
PIVOTS = 8
BINS = 256
_TABLE = bytes(c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_MEMO = 200_000
_U = np.uint64
_SEEDS = np.array([xxhash.xxh3_64_intdigest(b"table %d" % t) for t in range(TABLES)], _U)
_DESCRIBED = pa.schema(
    [("doc", pa.int64()), ("key", pa.binary()), ("digest", pa.binary()), ("shingles", pa.int64()), ("sketch", pa.list_(pa.int64())), ("bins", pa.binary())]
)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split()


class _WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _MEMO:
            self[word] = value
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def labelled_shingles(words: list[bytes], hashes: _WordHashes) -> np.ndarray:
    """Hashes of the shingles with their occurrence labels, in text order.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(hashes.__getitem__, words), _U, len(words))
    size = min(SHINGLE, len(h))
    x = h[: len(h) - size + 1].copy()
    for j in range(1, size):
        x = x * _U(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j]
    x = _mixed(x)
    order = np.argsort(x, kind="stable")
    run = x[order]
    again = run[1:] == run[:-1]
    if again.any():
        first = np.flatnonzero(np.append(True, ~again))
        label = np.empty(len(x), np.int64)
        label[order] = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
        x = _mixed(x + label.astype(_U) * _U(0xD6E8FEB86659FD93))
    return x


def sketch(x: np.ndarray) -> list[int]:
    """One signature for each table; none for a text without shingles."""
    if not len(x):
        return []
    ranks = _mixed(x[None] ^ _SEEDS[:, None])
    if len(x) > PICKS:
        least = np.sort(np.argpartition(ranks, PICKS, axis=1)[:, :PICKS], axis=1)
    else:
        least = np.broadcast_to(np.arange(len(x)), (TABLES, len(x)))
    out = _SEEDS.copy()
    for picked in x[least].T:  # in text order
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + picked)
    return out.view(np.int64).tolist()


def describe(docs: DataFrame) -> DataFrame:
    """(doc, key, digest, shingles, sketch, bins) of every row. Copies in one batch are sketched once."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches(stream):
            known: dict[bytes, tuple] = {}
            out: list[list] = [[] for _ in _DESCRIBED]
            for doc, key, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                plain = b" ".join(words) if words else b"\x00" + text.encode("utf-8", "replace")
                digest = hashlib.blake2b(plain, digest_size=16).digest()
                if digest not in known:
                    x = labelled_shingles(words, hashes)
                    bins = np.bincount((x >> _U(56)).astype(np.int64), minlength=BINS).astype("<u4").tobytes()
                    known[digest] = (len(x), sketch(x), bins)
                for column, value in zip(out, (doc, key, digest, *known[digest])):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _DESCRIBED)], schema=_DESCRIBED)

    return docs.select("doc", "key", "text").mapInArrow(run, "doc long, key binary, digest binary, shingles long, sketch array<long>, bins binary")


def chain(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Longest chain of equal labelled shingles in the order of both texts.

    A chain of at least ``least`` matches leaves each match a shift of at most
    max(m, n) - least: matches outside that band are dropped first.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = max(len(a), len(b)) - least
    close = np.abs(i - j) <= band
    i, j = i[close], j[close]
    if len(i) < least:
        return len(i)
    j = j[np.argsort(i)]
    if (j[1:] > j[:-1]).all():
        return len(j)
    tails: list[int] = []
    for value in j.tolist():
        at = bisect_left(tails, value)
        tails[at : at + 1] = [value]
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, wanted: float = SIMILARITY) -> float:
    """Similarity by aligned shingles; exact where it is at least ``wanted``, else below it."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    least = int(np.ceil(wanted * total / (1 + wanted) - 1e-9))
    if min(len(a), len(b)) < least:
        return 0.0
    matches = chain(a, b, least)
    return matches / (total - matches)


def _components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): components of ``labels`` joined by links (a, b) between nodes.

    Links are brought to components first. Components hook to their smallest
    neighbour and chains are shortened by jumping; links inside one component
    then go and equal ones merge, so each round looks only at what is left. Every
    step is a written table.
    """
    a, b = (labels.select(F.col("node").alias(n), F.col("comp").alias(f"c{n}")) for n in ("a", "b"))
    between = links.select("a", "b").join(a, "a").join(b, "b")
    while True:
        low, high = F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")
        between = materialise(between.filter("ca <> cb").select(low, high).distinct())
        if between.isEmpty():
            return labels
        both = between.unionByName(between.select(F.col("cb").alias("ca"), F.col("ca").alias("cb")))
        parents = materialise(both.groupBy("ca").agg(F.min("cb").alias("low")).select(F.col("ca").alias("node"), F.least("ca", "low").alias("up")))
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("next"))
            jumped = materialise(parents.join(above, "up").select("node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")))
            parents = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        labels = materialise(labels.join(parents.select(F.col("node").alias("comp"), "up"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))
        one, two = (parents.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}")) for c in ("ca", "cb"))
        between = between.join(one, "ca").join(two, "cb").select(F.col("up_ca").alias("ca"), F.col("up_cb").alias("cb"))


def _fits(m: Column, n: Column, wanted: float) -> Column:
    """Whether two shingle counts allow the similarity at all."""
    return F.least(m, n) >= F.greatest(m, n) * wanted


def _pivot_pairs(members: DataFrame, labels: DataFrame, picks: list[Column], wanted: float) -> DataFrame:
    """Pairs (a, b) of members and pivots of the same bucket, in different components.

    The pivots belong to the bucket's largest component: its own members, often most
    of the bucket, have nothing to ask then, and the others meet what they most likely join.
    The pivots are a written table, so that both sides of their join are plain
    shuffles (or one is small): a bucket with a large share of the rows can be split.
    """
    live = members.join(labels, "node")
    inside = live.groupBy("bucket", "comp").agg(
        F.count("*").alias("n"), F.array_distinct(F.array(*[F.min_by(F.struct("node", "comp", "shingles"), p) for p in picks])).alias("pivots")
    )
    chosen = inside.groupBy("bucket").agg(F.count("*").alias("comps"), F.max_by("pivots", F.struct("n", -F.col("comp"))).alias("pivots"))
    pivots = materialise(chosen.filter("comps > 1").select("bucket", F.explode("pivots").alias("pivot")))
    pairs = live.join(pivots, "bucket").filter((F.col("comp") != F.col("pivot.comp")) & _fits(F.col("shingles"), F.col("pivot.shingles"), wanted))
    return pairs.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()


def _remaining_pairs(members: DataFrame, labels: DataFrame, texts: DataFrame, wanted: float) -> DataFrame:
    """Pairs in different components that may still be similar, by their rarest shingles.

    In order of frequency, two texts of m and n shingles that are similar share
    one of the first m - wanted * m + 1 (n likewise), and after the first shared
    one enough must be left for the overlap they need. Texts with many shingles of
    their own share none, whatever the size of the group around them. Shingles
    within one component join nothing; of others, the texts outside the shingle's
    commonest component are paired with all.
    """
    live = members.join(labels, "node")
    mixed = materialise(live.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("bucket"))
    open_ = materialise(live.join(mixed, "bucket").select("node", "comp").distinct())

    def shingled(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        schema = pa.schema([("node", pa.int64()), ("m", pa.int64()), ("x", pa.list_(pa.int64()))])
        for batch in batches(stream):
            x = [labelled_shingles(words_of(t), hashes).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([len(v) for v in x], pa.int64()), pa.array(x, schema.field(2).type)], schema=schema)

    each = texts.join(open_, "node", "left_semi").select("node", "text").mapInArrow(shingled, "node long, m long, x array<long>")
    each = materialise(each.select("node", "m", F.explode("x").alias("x")))
    shared = materialise(each.groupBy("x").agg(F.count("*").alias("df")).filter("df > 1"))
    ordered = each.join(shared, "x").groupBy("node", "m").agg(F.array_sort(F.collect_list(F.struct("df", "x"))).alias("shared"))
    # Shingles met in one text only come first; they can't be shared.
    own = F.col("m") - F.size("shared")
    first = F.col("m") - F.ceil(F.col("m") * wanted - 1e-9) + 1
    prefix = ordered.withColumn("own", own).filter(first > own)
    prefix = prefix.select("node", "m", "own", F.posexplode(F.slice("shared", F.lit(1), (first - own).cast("int"))).alias("at", "s"))
    prefix = materialise(prefix.select("node", "m", (F.col("own") + F.col("at")).alias("at"), F.col("s.x").alias("x")).join(open_, "node"))
    common = prefix.groupBy("x", "comp").agg(F.count("*").alias("n")).groupBy("x")
    common = materialise(common.agg(F.count("*").alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("common")).filter("comps > 1"))
    mixed_x = prefix.join(common, "x")
    side = lambda d, n: d.select("x", *[F.col(c).alias(f"{c}_{n}") for c in ("node", "comp", "m", "at")])
    need = F.ceil((F.col("m_a") + F.col("m_b")) * (wanted / (1 + wanted)) - 1e-9)
    enough = F.least(F.col("m_a") - F.col("at_a"), F.col("m_b") - F.col("at_b")) >= need
    pairs = side(mixed_x.filter("comp <> common"), "a").join(side(mixed_x, "b"), "x").filter((F.col("comp_a") != F.col("comp_b")) & enough)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _possible(pairs: DataFrame, described: DataFrame, wanted: float) -> DataFrame:
    """Pairs whose shingle histograms still allow the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bound(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, BINS) for i in (2, 3))
            shared = np.minimum(one, two).sum(1)
            keep = shared >= wanted * (one.sum(1) + two.sum(1) - shared) - 1e-9
            yield pa.record_batch([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], schema=schema)

    one, two = (described.select(F.col("node").alias(n), F.col("bins").alias(f"bins_{n}")) for n in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "bins_a", "bins_b").mapInArrow(bound, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, wanted: float) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def align(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches(stream):
            held: dict[int, np.ndarray] = {}
            out = []
            for a, b, one, two in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for node, text in ((a, one), (b, two)):
                    if node not in held:
                        held[node] = labelled_shingles(words_of(text), hashes)
                out.append(similarity(held[a], held[b], wanted))
            score = np.array(out)
            keep = pa.array(score >= wanted - 1e-12)
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(score).filter(keep)], schema=schema)

    one, two = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in ("a", "b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(align, "a long, b long, similarity double")


def text_key(text: str) -> Column:
    """128 bits of a text's hash, by which rows of one doc_id are told apart; a null text is empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def near_classes(docs: DataFrame, wanted: float = SIMILARITY, with_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """Classes of near-duplicate rows of ``docs`` (doc_id, text), and the links between them.

    The first table has one row per row of ``docs``: doc_id, class_id (smallest
    doc_id of the class, which links connect), kept, and with ``with_key`` the row's
    text_key as ``key``. Of each class one doc_id and text is kept: of the smallest
    doc_id, and of its texts in the class the one of the smallest key. The
    second has the verified links (a, b, similarity) between smallest ids of
    rows with equal words. Null texts are empty; texts without words are alike
    only when equal; rows with equal words are of one class. Rows sharing a doc_id
    with different texts are classed each by its own text, those without a doc_id
    too, and a null doc_id comes last. An empty table gives empty tables; other
    columns are not looked at.
    """
    given = docs.select(F.col("doc_id").alias("doc"), text_key("text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    described = materialise(describe(given))
    row = F.struct(F.col("doc").isNull().alias("none"), "doc", "key")
    # A node is all rows with equal words, whatever their ids; written, so that its number stays.
    nodes = materialise(
        described.groupBy("digest")
        .agg(F.min(row).alias("first"), F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"), F.first("bins").alias("bins"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    signed = nodes.select("node", "shingles", F.posexplode("sketch").alias("table", "signature"))
    signed = signed.select("node", "shingles", F.xxhash64("table", "signature").alias("bucket"))
    full = materialise(signed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
    members = materialise(signed.join(full, "bucket").select("bucket", "node", "shingles"))
    candidates = materialise(members.select("node").distinct())
    firsts = nodes.join(candidates, "node", "left_semi").select("node", F.col("first.doc").alias("__doc"), F.col("first.key").alias("__key"))
    own = given["doc"].eqNullSafe(F.col("__doc")) & (given["key"] == F.col("__key"))
    texts = materialise(given.join(firsts, own).select("node", "text").dropDuplicates(["node"]))
    bins = materialise(nodes.join(candidates, "node", "left_semi").select("node", "bins"))

    labels = candidates.withColumn("comp", F.col("node"))
    found: list[DataFrame] = []
    tested: list[DataFrame] = []
    random = [F.xxhash64("node", F.lit(p)) for p in range(PIVOTS)]
    for picks in ([F.col("node")], random, None):
        pairs = _remaining_pairs(members, labels, texts, wanted) if picks is None else _pivot_pairs(members, labels, picks, wanted)
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        tested.append(materialise(pairs))
        links = materialise(_verified(materialise(_possible(tested[-1], bins, wanted)), texts, wanted))
        found.append(links)
        labels = _components(labels, links)
    links = reduce(DataFrame.unionByName, found)

    linked = labels.join(nodes.select("node", "first"), "node")
    least = linked.groupBy("comp").agg(F.count("*").alias("n"), F.min("first").alias("least")).filter("n > 1").drop("n")
    moved = labels.join(least, "comp").select("node", "least")
    by_digest = nodes.join(moved, "node", "left").select("digest", F.coalesce("least", "first").alias("least"))
    rows = described.select("doc", "key", "digest").join(by_digest, "digest")
    kept = F.col("doc").eqNullSafe(F.col("least.doc")) & (F.col("key") == F.col("least.key"))
    classes = rows.select(F.col("doc").alias("doc_id"), F.col("least.doc").alias("class_id"), kept.alias("kept"), *(["key"] if with_key else []))
    one, two = (nodes.select(F.col("node").alias(n), F.col("first.doc").alias(f"doc_{n}")) for n in ("a", "b"))
    named = links.join(one, "a").join(two, "b")
    return classes, named.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"), "similarity")

"""Language-model scores by a hierarchical Pitman-Yor model.

There is a restaurant for every context, the word before (the end, at the start of a
text), and all of them share one parent, the unigram restaurant, over a base measure that gives half its mass to words never seen. A customer is a token;
each table of a context restaurant is a customer of the parent. Seating is
sampled by Gibbs sweeps: block by block, all customers of one word in one
restaurant stand up and are seated again one by one with the probabilities of
the Chinese restaurant, given everybody else (of several such seatings one is
drawn by its importance weight, as seating one by one is not quite the
conditional distribution). Scores use the predictive probability averaged over the
last sweeps.

The corpus is counted by chunks of texts: a chunk sends each different (word, context)
once, with its count, to the shard of the word, so a frequent word or pair is one
entry per chunk. A word's restaurants meet in one shard: as many entries as different
words come before it. Shards are merged once and kept in a table bucketed by shard, so that
each sweep's totals come to them. Between sweeps the shards exchange the totals of their contexts: each
sends them to the contexts' groups, which add them and send them back, beside its seating, from which
the next sweep goes on; a few numbers
about the parent pass through the driver. Shards send back one probability per entry received, and
chunks sum them over their texts. Everything grows with the corpus in proportion.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import batches, remainder
from formweave.session import copies, kept_path, materialise

CONTEXTS = 4096  # groups of contexts whose totals are added together, at most
SWEEPS, KEPT, TRIES = 3, 2, 2
CHUNK_TOKENS = 3_000_000
SHARD_BYTES, MIN_SHARDS = 24 << 20, 32
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SENT = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary()), ("contexts", pa.binary())])
_SENT_SQL = "chunk long, shard int, words binary, pairs binary, counts binary, contexts binary"
_KEPT = pa.schema(
    [
        ("shard", pa.int32()),
        ("words", pa.int64()),
        ("pairs", pa.binary()),
        ("counts", pa.binary()),
        ("contexts", pa.binary()),
        ("chunks", pa.list_(pa.int64())),
        ("back", pa.list_(pa.binary())),
    ]
)
_KEPT_SQL = "shard int, words long, pairs binary, counts binary, contexts binary, chunks array<long>, back array<binary>"
_TOTAL = pa.schema([("owner", pa.int32()), ("shard", pa.int32()), ("contexts", pa.binary()), ("values", pa.binary()), ("facts", pa.list_(pa.float64()))])
_TOTAL_SQL = "owner int, shard int, contexts binary, values binary, facts array<double>"
_DOC = np.dtype([("doc", "<i8"), ("null", "?"), ("held", "?"), ("tokens", "<u4")])


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _packed(values: np.ndarray | bytes) -> bytes:
    """Compressed; numbers by their bytes' places, as high bytes hardly differ."""
    return zstandard.compress(values if isinstance(values, bytes) else _planes(values), 3)


def _numbers(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _close(keys: np.ndarray) -> bytes:
    """Sorted keys by the steps between them."""
    return _packed(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def _opened(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data, "<u8"))


def _distinct(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys (all below ``bound``, overwritten) in order, and which of them each key is.

    Keys carry their places through a sort in place where both fit 63 bits, which takes half the memory of an argsort.
    """
    bits = len(keys).bit_length()
    if int(bound).bit_length() + bits > 63:
        found, of_key = np.unique(keys, return_inverse=True)
        return found, of_key.astype(np.uint32)
    keys <<= bits
    keys |= np.arange(len(keys))
    keys.sort()
    at = (keys & ((1 << bits) - 1)).astype(np.uint32)
    keys >>= bits
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    of_key = np.empty(len(keys), np.uint32)
    of_key[at] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return keys[new], of_key


class _Local(dict):
    """Numbers words in order of appearance; the empty word, the end of a text, is 0."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered, then the end."""
    return [*text.encode("utf-8", "replace").translate(_LOWER).split(), b""]


def _groups(shards: int) -> int:
    return int(min(shards, CONTEXTS))


def _width(groups: int) -> np.uint64:
    """So many keys has a group of contexts at most."""
    return np.uint64((1 << 48) // groups + 1)


def context_keys(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Contexts go by 48 bits of their hash, in an order that keeps each group together.
    Among ten million words two meet with a chance of a sixth."""
    short = hashes >> np.uint64(16)
    return short % np.uint64(groups) * _width(groups) + short // np.uint64(groups)


def _chunk(chunk: int, docs: list[tuple], vocabulary: _Local, tokens: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """One row for each shard with the chunk's different pairs, and one with its texts as numbers of those."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    vocabulary.clear()
    size = len(hashes)
    shard = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((hashes, shard))  # words by shard and hash, pairs by those and context: as they are merged
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    contexts = context_keys(hashes, _groups(shards))
    by_key = np.argsort(contexts)
    contexts = contexts[by_key]
    rank = np.empty(size, np.uint32)
    rank[by_key] = np.arange(size)
    lengths = np.array([len(t) for t in tokens])
    # One long array at a time: a chunk's are most of a worker's memory.
    flat = np.concatenate(tokens)
    tokens.clear()
    keys = place[flat]
    keys *= size
    keys[0] += rank[0]
    keys[1:] += rank[flat[:-1]]  # a text's end, 0, stands before the next text's first word
    del flat
    pairs, inverse = _distinct(keys, size * size)
    del keys
    train = np.repeat(np.array([not d[1] for d in docs]), lengths)
    counts = np.bincount(inverse[train], minlength=len(pairs))
    of_word, before = np.divmod(pairs, size)
    del pairs
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    ends = np.searchsorted(of_word, cuts)
    for s in range(shards):
        a, b, c, d = cuts[s], cuts[s + 1], ends[s], ends[s + 1]
        if a < b:
            used, context = np.unique(before[c:d], return_inverse=True)
            sent = _close(hashes[order[a:b]] // np.uint64(shards)), _close(((of_word[c:d] - a) * len(used) + context).astype(np.uint64))
            parts = [pa.array([v], pa.binary()) for v in (*sent, _packed(counts[c:d].astype("<u8")), _close(contexts[used]))]
            yield pa.record_batch([[chunk], pa.array([s], pa.int32()), *parts], schema=_SENT)
    held = np.array([(0 if i is None else i, i is None, h, n) for (i, h), n in zip(docs, lengths)], _DOC)
    parts = [pa.array([v], pa.binary()) for v in (held.tobytes(), _packed(inverse.astype("<u4", copy=False)), b"", b"")]
    yield pa.record_batch([[chunk], pa.array([-1], pa.int32()), *parts], schema=_SENT)


def count_chunks(docs: DataFrame, shards: int) -> DataFrame:
    """Chunks of ``docs`` (doc_id, held_out, text), for the shards (shard >= 0) and for themselves (-1)."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 20, 0
        ids, tokens, total = [], [], 0
        vocabulary = _Local({b"": 0})
        for b in batches(stream):
            for doc, held, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                ids.append((doc, held))
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
                total += len(words)
                if total >= CHUNK_TOKENS:
                    yield from _chunk(base + made, ids, vocabulary, tokens, shards)
                    ids, tokens, total, made = [], [], 0, made + 1
                    vocabulary = _Local({b"": 0})
        if ids:
            yield from _chunk(base + made, ids, vocabulary, tokens, shards)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _SENT_SQL)


@dataclass
class Shard:
    """The merged counts of a shard's words; pairs are sorted by word and context."""

    word: np.ndarray  # of each pair
    context: np.ndarray
    count: np.ndarray
    words: int
    back: list[np.ndarray]  # for each sender, the merged pair of each of its pairs, in order
    back_word: list[np.ndarray]  # and the merged word of each of its words
    contexts: np.ndarray | None = None  # their keys, in order


def merged(words: list[bytes], pairs: list[bytes], counts: list[bytes], contexts: list[bytes]) -> Shard:
    every = [_opened(c) for c in contexts]
    known, of_context = np.unique(np.concatenate(every), return_inverse=True)
    cut = lambda a, lengths: np.split(a, np.cumsum(lengths)[:-1])
    of_context = cut(of_context, [len(c) for c in every])
    heads = [_opened(w) for w in words]
    hashes, of_word = np.unique(np.concatenate(heads), return_inverse=True)
    of_word = cut(of_word, [len(h) for h in heads])
    del every, heads
    keys = []
    for w, c, sent in zip(of_word, of_context, pairs):
        word, context = np.divmod(_opened(sent), np.uint64(len(c)))
        keys.append(w[word] * len(known) + c[context])
    lengths = [len(k) for k in keys]
    keys = np.concatenate(keys)
    keys, of_pair = _distinct(keys, len(hashes) * len(known))
    received = np.concatenate([_numbers(c, "<u8") for c in counts])
    count = np.bincount(of_pair, weights=received, minlength=len(keys)).astype(np.int64)
    word, context = np.divmod(keys, len(known))
    return Shard(word.astype(np.uint32), context.astype(np.uint32), count, len(hashes), cut(of_pair, lengths), of_word, known)


def _merged(pairs: DataFrame, shards: int, name: str, path: str) -> DataFrame:
    """The shards, merged and kept as a table bucketed by shard: totals come to them, not they to the totals."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            for number, chunks, *sent in zip(*(c.to_pylist() for c in b.columns)):
                shard = merged(*sent)
                back = [_packed(np.diff(at, prepend=np.uint32(0)).astype("<u4")) for at in shard.back]
                keys = shard.word.astype(np.uint64) * np.uint64(len(shard.contexts)) + shard.context
                row = [number], [shard.words], [_close(keys)], [_packed(shard.count.astype("<u8"))], [_close(shard.contexts)], [chunks], [back]
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(row, _KEPT)], schema=_KEPT)
                del shard, keys, back, row

    columns = ("chunk", "words", "pairs", "counts", "contexts")
    gathered = pairs.repartition(shards, "shard").groupBy("shard").agg(F.collect_list(F.struct(*columns)).alias("sent"))
    kept = gathered.select("shard", *[F.col(f"sent.{c}").alias(c) for c in columns]).mapInArrow(run, _KEPT_SQL)
    kept.write.format("parquet").bucketBy(shards, "shard").option("path", path).saveAsTable(name)
    return pairs.sparkSession.table(name)


def _opened_shard(words: int, pairs: bytes, counts: bytes, contexts: bytes) -> Shard:
    known = _opened(contexts)
    word, context = np.divmod(_opened(pairs), np.uint64(len(known)))
    return Shard(word.astype(np.uint32), context.astype(np.uint32), _numbers(counts, "<u8").astype(np.int64), words, [], [], known)


@dataclass
class Totals:
    """What a sweep needs from all other shards."""

    tables: np.ndarray  # by context
    parent_customers: float
    parent_tables: float


@dataclass
class Model:
    customers: np.ndarray  # by context
    tokens: int
    words: int
    discount: float
    parent_discount: float
    concentration: float = 1.0
    totals: list[Totals] = field(default_factory=list)

    def base(self, seen: np.ndarray) -> np.ndarray:
        """Half of the base measure is for all words never seen, half for the seen ones alike."""
        return np.where(seen, 0.5 / max(self.words, 1), 0.5)


def seat(count: np.ndarray, rest: np.ndarray, p: np.ndarray, concentration: float, discount: float, random) -> tuple[np.ndarray, np.ndarray]:
    """Seat each block's customers one by one; returns tables and log importance weights.

    The k-th table of a block opens with weight (concentration + discount *
    (rest + k)) * p, rest being the restaurant's other tables. The first 32 customers
    are seated one at a time; those after, in stretches of a 32nd of those
    seated, over which the chance of a new table hardly changes: it is taken at the middle. So
    a block costs as much as the logarithm of its customers.
    """
    tables, weight = np.ones(len(count), np.int64), np.zeros(len(count))
    at = np.flatnonzero(count > 1)
    seated = 1
    while len(at):
        stretch = np.minimum(max(1, seated // 32), count[at] - seated)
        middle = seated + (stretch - 1) / 2
        opened = tables[at].astype(float)
        for _ in range(1 if seated < 32 else 2):
            new = (concentration + discount * (rest[at] + opened)) * p[at]
            total = middle - discount * opened + new
            opened = tables[at] + new / total * (stretch - 1) / 2
        weight[at] += stretch * np.log(total)
        tables[at] += random.binomial(stretch, np.minimum(new / total, 1.0))
        seated += max(1, seated // 32)
        at = at[count[at] > seated]
    return tables, weight


def _reseat(count, rest, p, concentration, discount, random) -> np.ndarray:
    """A seating drawn from several by importance; a customer alone has one table."""
    drawn, many = np.ones(len(count), np.int64), np.flatnonzero(count > 1)
    count, rest, p = count[many], rest[many], p[many]
    tables, weight = seat(count, rest, p, concentration, discount, random)
    best = weight.copy()
    for _ in range(TRIES - 1):
        other, w = seat(count, rest, p, concentration, discount, random)
        best = np.logaddexp(best, w)
        take = np.log(random.random(len(drawn))[many]) < w - best
        tables = np.where(take, other, tables)
    drawn[many] = tables
    return drawn


@dataclass
class Seating:
    tables: np.ndarray  # of each pair that has customers
    parent: np.ndarray  # tables of each word in the parent

    def shown(self, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables of each pair, parent customers and tables of each word."""
        tables = np.zeros(len(shard.count), np.int64)
        tables[shard.count > 0] = self.tables
        return tables, np.bincount(shard.word, weights=tables, minlength=shard.words).astype(np.int64), self.parent


def sweep(shard: Shard, model: Model, s: int, last: Seating | None) -> Seating:
    """Run sweep ``s`` over one shard from the seating of the sweep before, given the totals before each.

    The random numbers depend on shard and sweep only, so a task that is run again seats everybody the same.
    """
    held = np.flatnonzero(shard.count > 0)
    count, word, context = shard.count[held], shard.word[held], shard.context[held]
    own = np.bincount(word, weights=count, minlength=shard.words)
    seen = own > 0
    base = model.base(seen)
    if last is None:
        last = Seating(np.ones(len(held), np.int64), seen.astype(np.int64))
        unigram = np.where(seen, np.maximum(own - model.parent_discount, 0.05), 0) / max(model.tokens, 1) + base * 1e-3
    else:
        unigram = unigram_probability(model, model.totals[s - 1], *last.shown(shard)[1:], base)
    before = model.totals[s]
    random = np.random.default_rng([s, len(held), int(own.sum())])
    rest = np.maximum(before.tables[context] - last.tables, 0)
    tables = _reseat(count, rest, unigram[word], model.concentration, model.discount, random)
    customers = np.bincount(word, weights=tables, minlength=shard.words).astype(np.int64)
    at = np.flatnonzero(seen)
    others = np.maximum(before.parent_tables - last.parent[at], 0)
    parent = last.parent.copy()
    parent[at] = _reseat(customers[at], others, base[at], model.concentration, model.parent_discount, random)
    return Seating(tables, parent)


def sweeps(shard: Shard, model: Model, number: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Run the first sweeps over one shard, given the totals before each of them.

    Yields (sweep, tables of each pair, parent customers and tables of each word).
    """
    last = None
    for s in range(number):
        last = sweep(shard, model, s, last)
        yield s, *last.shown(shard)


def unigram_probability(model: Model, totals: Totals, customers: np.ndarray, tables: np.ndarray, base: np.ndarray) -> np.ndarray:
    whole = model.concentration + totals.parent_customers
    spare = (model.concentration + model.parent_discount * totals.parent_tables) / whole
    return (customers - model.parent_discount * tables) / whole + spare * base


def probabilities(shard: Shard, model: Model, seatings: Iterable[tuple[int, np.ndarray, np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """Predictive probability of each pair, averaged over the last sweeps; they are run unless their ``seatings`` are given."""
    seen = np.bincount(shard.word, weights=shard.count, minlength=shard.words) > 0
    total = np.zeros(len(shard.count))
    for s, tables, customers, parent in sweeps(shard, model, SWEEPS) if seatings is None else seatings:
        if s >= SWEEPS - KEPT:
            after = model.totals[s + 1]
            unigram = unigram_probability(model, after, customers, parent, model.base(seen))
            whole = model.concentration + model.customers[shard.context]
            spare = (model.concentration + model.discount * after.tables[shard.context]) / whole
            total += (shard.count - model.discount * tables) / whole + spare * unigram[shard.word]
    return total / KEPT


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.95))


def _totals(number: int, shard: Shard, groups: int, values: list[np.ndarray], facts: list[float]) -> Iterator[pa.RecordBatch]:
    """A shard's numbers by context, one row for each group of contexts, and what is summed over all shards."""
    cuts = np.searchsorted(shard.contexts, np.arange(groups + 1, dtype=np.uint64) * _width(groups))
    yield pa.record_batch([[-1], [number], [b""], [b""], [facts]], schema=_TOTAL)
    for g in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[g], cuts[g + 1])
        sent = _packed(np.concatenate([v[part] for v in values]).astype("<u8"))
        yield pa.record_batch([[int(g)], [number], [_close(shard.contexts[part])], [sent], [None]], schema=_TOTAL)


def _exchanged(rows: DataFrame, facts: int, shards: int) -> tuple[np.ndarray, DataFrame]:
    """Facts summed, and for each shard (shard, told) its contexts' numbers summed over all shards, by group,
    then what it sent to itself, if it did: a row owned by no group but the number of groups and its own."""
    schema = pa.schema([("owner", pa.int32()), ("shard", pa.int32()), ("values", pa.binary())])
    groups = _groups(shards)

    def add(t: pa.Table) -> pa.Table:
        owner = t["owner"][0].as_py()
        if owner < 0:
            summed = np.sum([f.as_py() for f in t["facts"]], 0)
            return pa.table([t["owner"][:1], pa.array([-1], pa.int32()), pa.array([summed.tobytes()], pa.binary())], schema=schema)
        if owner >= groups:
            return t.select(schema.names).cast(schema)
        contexts = [_opened(c.as_py()) for c in t["contexts"]]
        values = [_numbers(v.as_py(), "<u8").reshape(-1, len(c)) for v, c in zip(t["values"], contexts)]
        _, at = np.unique(np.concatenate(contexts), return_inverse=True)
        sums = np.stack([np.bincount(at, weights=v)[at] for v in np.concatenate(values, 1)]).astype("<u8")
        ends = np.cumsum([len(c) for c in contexts])
        back = [_packed(sums[:, e - len(c) : e].ravel()) for e, c in zip(ends, contexts)]
        return pa.table([t["owner"], t["shard"], pa.array(back, pa.binary())], schema=schema)

    added = materialise(rows.groupBy("owner").applyInArrow(add, "owner int, shard int, values binary"))
    whole = added.filter("shard < 0").first()
    told = added.filter("shard >= 0").repartition(shards, "shard").groupBy("shard")
    told = told.agg(F.sort_array(F.collect_list(F.struct("owner", "values"))).alias("told"))
    return np.zeros(facts) if whole is None else np.frombuffer(whole["values"]), told.select("shard", F.col("told.values").alias("told"))


def _with_told(kept: DataFrame, *told: DataFrame) -> DataFrame:
    """The shards beside the totals of their contexts."""
    for k, t in enumerate(told):
        kept = kept.join(t.withColumnRenamed("told", f"told{k}").hint("shuffle_hash"), "shard")
    return kept


def _first_told(told: list[bytes]) -> np.ndarray:
    """Customers and tables of a shard's contexts."""
    return np.concatenate([_numbers(v, "<u8").reshape(2, -1) for v in told], 1).astype(float)


def _later_told(told: list[bytes], shard: Shard) -> tuple[np.ndarray, Seating]:
    """Tables of a shard's contexts, and its own seating."""
    *tables, seating = told
    seating = np.split(_numbers(seating, "<u8").astype(np.int64), [np.count_nonzero(shard.count)])
    return np.concatenate([_numbers(v, "<u8") for v in tables]).astype(float), Seating(*seating)


def _local(model: Model, tables: dict[int, np.ndarray]) -> Model:
    """The model with the totals of one shard's contexts."""
    return replace(model, totals=[replace(t, tables=tables.get(k, t.tables)) for k, t in enumerate(model.totals)])


def _counted(kept: DataFrame, shards: int) -> tuple[Model, DataFrame]:
    """Counts over all shards, and the totals with one table a pair."""
    groups = _groups(shards)

    def count(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            for number, *stored in zip(*(c.to_pylist() for c in b.columns)):
                shard = _opened_shard(*stored)
                own = np.bincount(shard.word, weights=shard.count, minlength=shard.words)
                sizes = lambda c: [(c == 1).sum(), (c == 2).sum()]
                facts = [own.sum(), (own > 0).sum(), *sizes(shard.count), *sizes(own), (shard.count > 0).sum()]
                vector = lambda w: np.bincount(shard.context, weights=w, minlength=len(shard.contexts))
                yield from _totals(number, shard, groups, [vector(shard.count), vector(shard.count > 0)], [float(f) for f in facts])
                del shard

    rows = kept.select("shard", "words", "pairs", "counts", "contexts").mapInArrow(count, _TOTAL_SQL)
    (tokens, words, one, two, parent_one, parent_two, pairs), told = _exchanged(rows, 7, shards)
    none = np.zeros(0)
    model = Model(none, int(tokens), int(words), _discount(one, two), _discount(parent_one, parent_two))
    model.totals.append(Totals(none, float(pairs), float(words)))
    return model, told


def _swept(kept: DataFrame, told: DataFrame, model: Model, s: int, shards: int) -> tuple[Totals, DataFrame]:
    """Totals after sweep ``s``, given what the shards were told before it."""
    groups = _groups(shards)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            for n, *stored, heard in zip(*(c.to_pylist() for c in b.columns)):
                shard = _opened_shard(*stored)
                tables, last = _later_told(heard, shard) if s else (_first_told(heard)[1], None)
                seating = sweep(shard, _local(model, {s: tables}), s, last)
                tables, customers, parent = seating.shown(shard)
                by_context = np.bincount(shard.context, weights=tables, minlength=len(shard.contexts))
                yield from _totals(n, shard, groups, [by_context], [float(customers.sum()), float(parent.sum())])
                own = _packed(np.concatenate([seating.tables, seating.parent]).astype("<u8"))
                yield pa.record_batch([[groups + n], [n], [b""], [own], [None]], schema=_TOTAL)
                del shard, tables, seating, last

    rows = _with_told(kept.select("shard", "words", "pairs", "counts", "contexts"), told).mapInArrow(run, _TOTAL_SQL)
    parent, heard = _exchanged(rows, 2, shards)
    return Totals(np.zeros(0), float(parent[0]), float(parent[1])), heard


def _answers(kept: DataFrame, told: list[DataFrame], model: Model) -> DataFrame:
    """For each chunk and shard: the count of each word sent, and log10 probabilities of its pairs."""
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary()), ("scores", pa.binary())])
    last = range(SWEEPS - KEPT, SWEEPS)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            for number, words, pairs, counts, contexts, chunks, back, first, *heard in zip(*(c.to_pylist() for c in b.columns)):
                shard = _opened_shard(words, pairs, counts, contexts)
                later = {s: _later_told(h, shard) for s, h in zip(last, heard)}
                local = replace(_local(model, {s + 1: tables for s, (tables, _) in later.items()}), customers=_first_told(first)[0])
                seatings = ((s, *seating.shown(shard)) for s, (_, seating) in later.items())
                score = np.log10(probabilities(shard, local, seatings)).astype("<f4")
                own = np.bincount(shard.word, weights=shard.count, minlength=shard.words).astype("<u8")
                for chunk, steps in zip(chunks, back):
                    pair = np.cumsum(_numbers(steps, "<u4"), dtype=np.int64)
                    word, sizes = np.unique(shard.word[pair], return_counts=True)
                    row = ([chunk], pa.array([number], pa.int32()), *(pa.array([_packed(v)], pa.binary()) for v in (sizes.astype("<u4"), own[word], score[pair])))
                    yield pa.record_batch(list(row), schema=schema)
                del shard, later, local, score, pair

    return _with_told(kept, told[0], *(told[s + 1] for s in last)).mapInArrow(run, "chunk long, shard int, pairs binary, counts binary, scores binary")


def _scored(texts: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("train_tokens", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )
    tokens, words = model.tokens, model.words

    def run(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        answer = answer.sort_by("shard")
        column = lambda n, kind: np.concatenate([_numbers(x.as_py(), kind) for x in answer[n]])
        count = np.repeat(column("counts", "<u8"), column("pairs", "<u4"))
        score = column("scores", "<f4").astype(float)
        base = np.log10((count + 0.5) / (tokens + 0.5 * (words + 1)))
        docs = np.frombuffer(chunk["words"][0].as_buffer(), _DOC)
        pair = _numbers(chunk["pairs"][0].as_py(), "<u4")
        starts = np.append(0, np.cumsum(docs["tokens"].astype(np.int64))[:-1])
        by_doc = lambda v: np.add.reduceat(v[pair], starts)
        return pa.table(
            [
                pa.array(docs["doc"], mask=docs["null"]),
                pa.array(docs["held"]),
                docs["tokens"].astype(np.int64),
                by_doc((count > 0).astype(np.int64)),
                np.full(len(docs), tokens, np.int64),
                by_doc(base),
                by_doc(score),
            ],
            schema=schema,
        )

    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, columns)


def score_language(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text), learning from those whose
    crc32(doc_id) modulo ``modulus`` is not 1.

    Returns per row: doc_id, held_out, n_tokens (words and one end), n_known
    (tokens met in training), train_tokens, base_score (log10 probability under
    smoothed unigram counts), score (log10 probability under the model). A null
    or empty text is the end alone. Repeated rows count and are scored each; an
    empty table gives an empty table; other columns are not looked at.
    """
    texts = docs.select("doc_id", (remainder("doc_id", modulus) == 1).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(max(MIN_SHARDS, size // SHARD_BYTES))
    spark = docs.sparkSession
    result, name = kept_path(spark, "formweave"), f"formweave_{uuid.uuid4().hex}"
    with copies(spark):
        path = kept_path(spark, "formweave")
        sent = count_chunks(texts, shards).withColumn("kind", F.when(F.col("shard") < 0, "texts").otherwise("pairs"))
        sent.write.partitionBy("kind").parquet(path)
        read = lambda kind: spark.read.schema(sent.schema).parquet(path).filter(F.col("kind") == kind).drop("kind")
        try:
            kept = _merged(read("pairs"), shards, name, kept_path(spark, "formweave"))
            # Merged pairs are kept in a table of their own: what the chunks sent is not read again.
            with copies(spark) as spent:
                spent.append(f"{path}/kind=pairs")
            model, first = _counted(kept, shards)
            told = [first]
            for s in range(SWEEPS):
                totals, heard = _swept(kept, told[s], model, s, shards)
                model.totals.append(totals)
                told.append(heard)
            scored = _scored(read("texts"), _answers(kept, told, model), model)
            scored.write.parquet(result)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(scored.schema).parquet(result)

"""Repeated passages across a corpus, by a hash-compared suffix sort.

A byte is repeated when it lies in a string of LENGTH bytes that also starts
earlier (in a document of smaller id, or earlier in its own). All strings of that
length, at every byte of every text, are decided, in these steps.

1. Texts that equal one of a smaller id are repeated whole; of the others:
2. Each string is assigned to the least-hashed gram inside it (its anchor). Equal
   strings have equal anchors at equal places, so only strings whose anchor also
   stands elsewhere can be repeated. Anchor hashes are grouped in shards.
3. For anchors standing more than once, the bytes around them, enough for all
   strings assigned to them, go to the shard of the anchor. There, the suffixes that begin at
   those strings are sorted by merging: two suffixes are compared by binary
   search for their common extension over prefix polynomial hashes. Neighbours
   that agree over LENGTH bytes are compared byte by byte, and the earliest of
   each run stays.
4. Anchors with very many surroundings, such as the ends of a passage that a
   large part of the corpus shares, are not gathered in one shard: each of their
   strings goes, with its bytes, to the shard of the whole string's hash. Equal strings
   still meet, and step 3 decides them there as it does all others.
5. The strings found are joined to intervals, per document.

Copies within one batch of texts are settled before anything is shuffled, so a
passage common to most documents sends one record per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.llm.common import batches, release
from formweave.session import materialise

LENGTH, GRAM = 100, 32
# Bytes of text behind one shard, and the fewest shards.
SHARD_BYTES, MIN_SHARDS = 4 << 20, 32
# Bytes hashed at once, and powers that a worker keeps.
SLICE = 1 << 19
KEPT_POWERS = 1 << 21
# Strings of different surroundings that are sorted at once.
SORTED = 200_000
# An anchor standing more often than this is dealt over the shards string by string.
HOT = 2000
_LAST = (1 << 63) - 1  # stands for a null doc_id: after all others
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_POWERS: dict[int, list[np.ndarray]] = {}
_CONTEXT = np.dtype([("doc", "<i8"), ("key", "<i8"), ("at", "<u4"), ("ahead", "<u2"), ("strings", "<u2"), ("size", "<u4")])
_SHARDED = pa.schema([("shard", pa.int32()), ("records", pa.binary()), ("data", pa.binary())])
_SHARDED_SQL = "shard int, records binary, data binary"
_SPANS = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("spans", pa.binary())])


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least n of each."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        held = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.empty(size, _U)
            out[0] = 1
            filled = 1
            while filled < size:  # doubling: the next powers are the first ones times base^filled
                more = min(filled, size - filled)
                out[filled : filled + more] = out[:more] * _U(pow(b, filled, 1 << 64))
                filled += more
            held.append(out)
        if size <= KEPT_POWERS:
            _POWERS[base] = held
    return held[0], held[1]


class Prefixes:
    """Prefix polynomial hashes of a buffer: the hash of any part in constant time."""

    def __init__(self, buffer: np.ndarray, base: int = _BASE):
        power, self.inverse = _powers(base, len(buffer) + 1)
        self.sums = np.empty(len(buffer) + 1, _U)
        self.sums[0] = 0
        for a in range(0, len(buffer), SLICE):
            terms = buffer[a : a + SLICE].astype(_U)
            terms += _U(1)
            terms *= power[a : a + SLICE][: len(terms)]
            terms[:1] += self.sums[a : a + 1]
            np.cumsum(terms, out=self.sums[a + 1 : a + 1 + len(terms)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(29))


def anchors(prefixes: Prefixes, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of a buffer of texts beginning at ``starts`` (with the end last).

    Returns arrays: place of the anchor, first and last start of the strings
    assigned to it (they follow one another), and the hash of its gram.
    """
    n = int(starts[-1])
    width = length - gram + 1
    if n < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, _U)
    count = n - gram + 1
    at = np.arange(count)
    value = _mixed(prefixes.of(at, at + gram))
    least, place, reach = value, at, 1
    while reach < width:  # least value over ever wider windows; of equal ones the last
        step = min(reach, width - reach)
        later, after = least[step:], place[step:]
        smaller = later <= least[: len(later)]
        least, place = np.where(smaller, later, least[: len(later)]), np.where(smaller, after, place[: len(later)])
        reach += step
    owner = np.searchsorted(starts, np.arange(n - length + 1), side="right") - 1
    valid = np.arange(n - length + 1) + length <= starts[owner + 1]
    p = np.flatnonzero(valid)
    x = place[p]
    new = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (p[1:] != p[:-1] + 1))) if len(p) else np.zeros(0, int)
    ends = np.append(new[1:], len(p))
    return x[new], p[new], p[ends - 1], value[x[new]]


def _buffers(rows: list[tuple], size: int = 1 << 20) -> Iterator[list[tuple]]:
    """Rows (.., .., data) in groups of about ``size`` bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[2])
        if total > size:
            yield held
            held, total = [], 0
    if held:
        yield held


def _laid(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    return buffer, np.append(0, np.cumsum([len(r[2]) for r in rows]))


def _split(records: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1])) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(shard[order[a]]), records[order[a:b]]


def anchor_table(texts: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """(shard, records): the anchor hashes of every text with its key and place.

    A task sends each different text once, however many copies it reads.
    """
    kind = np.dtype([("hash", "<u8"), ("key", "<i8"), ("at", "<u4")])
    schema = pa.schema([("shard", pa.int32()), ("records", pa.binary())])

    def send(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sent: set[int] = set()
        for b in batches(stream):
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key not in sent:
                    sent.add(key)
                    rows.append((0, key, text.encode("utf-8", "replace")))
            for part in _buffers(rows):
                buffer, starts = _laid(part)
                x, _, _, h = anchors(Prefixes(buffer), starts, length, gram)
                owner = np.searchsorted(starts, x, side="right") - 1
                records = np.empty(len(x), kind)
                records["hash"], records["at"] = h, x - starts[owner]
                records["key"] = np.array([r[1] for r in part], np.int64)[owner]
                for shard, some in _split(records, (_mixed(h) % _U(shards)).astype(np.int32)):
                    yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([some.tobytes()], pa.binary())], schema=schema)

    return texts.select("key", "text").mapInArrow(send, "shard int, records binary")


def repeated_anchors(table: DataFrame, hot: int) -> DataFrame:
    """(key, places): for each text its anchors that also stand elsewhere, as
    32-bit numbers; the highest bit marks hot anchors."""
    kind = np.dtype([("hash", "<u8"), ("key", "<i8"), ("at", "<u4")])
    schema = pa.schema([("key", pa.int64()), ("places", pa.binary())])

    def group(shard: pa.Table) -> pa.Table:
        r = np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in shard["records"]])
        r = r[np.argsort(r["hash"], kind="stable")]
        first = np.flatnonzero(np.append(True, r["hash"][1:] != r["hash"][:-1]))
        sizes = np.diff(np.append(first, len(r)))
        lead = np.repeat(first, sizes)
        other = (r["key"] != r["key"][lead]) | (r["at"] != r["at"][lead])
        many = np.repeat(np.add.reduceat(other, first) > 0, sizes)
        places = r["at"] | np.where(np.repeat(sizes > hot, sizes), np.uint32(1 << 31), np.uint32(0))
        keys, places = r["key"][many], places[many]
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(keys))
        return pa.table([keys[cuts], pa.array([places[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())], schema=schema)

    return table.groupBy("shard").applyInArrow(group, "key long, places binary")


def surroundings(joined: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """(shard, records, data): what the shards need to decide the strings of repeated anchors.

    ``joined``: (doc, key, text, places). Strings repeated within one batch are
    settled here, and only reported (a record without bytes).
    """

    def send(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            columns = [b.column(b.schema.get_field_index(n)).to_pylist() for n in ("doc", "key", "text", "places")]
            rows = sorted(((d, k, t.encode("utf-8", "replace"), m) for d, k, t, m in zip(*columns)), key=lambda r: r[:2])
            seen: dict[tuple[int, bytes], tuple[int, int]] = {}
            for part in _buffers(rows):
                yield from _send_part(part, seen, shards, length, gram)

    return joined.mapInArrow(send, _SHARDED_SQL)


def _send_part(part: list[tuple], seen: dict, shards: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    buffer, starts = _laid(part)
    prefixes = Prefixes(buffer)
    x, low, high, h = anchors(prefixes, starts, length, gram)
    owner = np.searchsorted(starts, x, side="right") - 1
    marked, warm = [], []
    for base, row in zip(starts, part):
        places = np.concatenate([np.frombuffer(m, "<u4") for m in row[3]]) if row[3] else np.zeros(0, "<u4")
        marked.append((places & np.uint32((1 << 31) - 1)).astype(np.int64) + base)
        warm.append(places >= np.uint32(1 << 31))
    wanted = np.concatenate(marked) if marked else np.zeros(0, np.int64)
    is_hot = np.zeros(len(buffer) + 1, np.int8)
    is_hot[wanted] = 1
    is_hot[wanted[np.concatenate(warm)]] = 2
    docs, keys = (np.array([r[i] for r in part], np.int64) for i in (0, 1))
    shard_of = (_mixed(h) % _U(shards)).astype(np.int32)

    kind, raw = is_hot[x], buffer.tobytes()
    chosen = np.flatnonzero(kind == 1)
    records = np.empty(len(chosen), _CONTEXT)
    mine = owner[chosen]
    records["doc"], records["key"], records["at"] = docs[mine], keys[mine], low[chosen] - starts[mine]
    records["ahead"], records["strings"] = x[chosen] - low[chosen], high[chosen] - low[chosen] + 1
    sizes = high[chosen] - low[chosen] + length
    data: list[bytes] = []
    doc_at = zip(records["doc"].tolist(), records["at"].tolist())
    for i, (a, size, ahead, place) in enumerate(zip(low[chosen].tolist(), sizes.tolist(), records["ahead"].tolist(), doc_at)):
        context = (ahead, raw[a : a + size])
        if seen.setdefault(context, place) == place:
            data.append(context[1])
        else:
            sizes[i] = 0
            data.append(b"")
    records["size"] = sizes
    for shard, at in _split(np.arange(len(chosen)), shard_of[chosen]):
        yield _sharded(shard, records[at], b"".join([data[i] for i in at]))

    chosen = np.flatnonzero(kind == 2)
    if len(chosen):
        counts = high[chosen] - low[chosen] + 1
        p = np.repeat(low[chosen] - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
        mine = np.repeat(owner[chosen], counts)
        strings = np.empty(len(p), _CONTEXT)
        strings["doc"], strings["key"], strings["at"] = docs[mine], keys[mine], p - starts[mine]
        strings["ahead"], strings["strings"], strings["size"] = np.repeat(x[chosen], counts) - p, 1, length
        whole = _mixed(prefixes.of(p, p + length))
        # The texts are in order, so the first of equal strings is the earliest here.
        order = np.argsort(whole, kind="stable")
        strings, p, whole = strings[order], p[order], whole[order]
        first = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
        lead = np.repeat(first, np.diff(np.append(first, len(p))))
        again = (strings["doc"] != strings["doc"][lead]) | (strings["at"] != strings["at"][lead])
        again[again] = _equal_bytes(buffer, p[lead[again]], p[again], length)
        strings["size"][again] = 0
        for shard, at in _split(np.arange(len(p)), (whole % _U(shards)).astype(np.int32)):
            yield _sharded(shard, strings[at], buffer[p[at[~again[at]]][:, None] + np.arange(length)].tobytes())


def _sharded(shard: int, records: np.ndarray, data: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([shard], pa.int32()), pa.array([records.tobytes()], pa.binary()), pa.array([data], pa.binary())], schema=_SHARDED)


def _equal_bytes(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at ``a`` and ``b`` are the same, byte by byte."""
    same, span = np.zeros(len(a), bool), np.arange(length)
    for i in range(0, len(a), 1 << 12):
        some = slice(i, i + (1 << 12))
        same[some] = (buffer[a[some][:, None] + span] == buffer[b[some][:, None] + span]).all(1)
    return same


def common_extension(prefixes: Prefixes, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``limit``, by
    binary search over prefix hashes. Both have at least ``limit`` bytes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), limit)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = prefixes.of(a, a + middle) == prefixes.of(b, b + middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def _less(buffer: np.ndarray, prefixes: Prefixes, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Whether the suffix at a is smaller than that at b, in their first ``limit`` bytes."""
    e = common_extension(prefixes, a, b, limit)
    whole = e == limit
    step = np.where(whole, 0, e)
    return ~whole & (buffer[a + step] < buffer[b + step])


def sort_suffixes(buffer: np.ndarray, prefixes: Prefixes, starts: np.ndarray, groups: np.ndarray, limit: int) -> np.ndarray:
    """Order of ``starts`` by (group, first ``limit`` bytes), stable, by merging sorted runs.

    All pairs of runs of a level are merged at once: the place of an element in
    the merged run is its place in its own run plus the number of elements of the sister run
    before it, found by binary search.
    """
    order = np.argsort(groups, kind="stable")
    n = len(order)
    if not n:
        return order
    g = groups[order]
    begin = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    sizes = np.diff(np.append(begin, n))
    first, size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
    inside = np.arange(n) - first
    run = 1
    while run < size.max():
        active = np.flatnonzero(size > run)
        i, base, total = inside[active], first[active], size[active]
        right = (i // run) % 2 == 1
        pair = i // (2 * run) * (2 * run)
        sister = np.where(right, pair, np.minimum(pair + run, total))
        stop = np.where(right, pair + run, np.minimum(pair + 2 * run, total))
        own = starts[order[active]]
        low, high = sister.copy(), stop.copy()
        while True:
            at = np.flatnonzero(low < high)
            if not len(at):
                break
            middle = (low[at] + high[at]) >> 1
            other = starts[order[base[at] + middle]]
            # Left elements stand before equal ones of the right run.
            before = np.where(right[at], ~_less(buffer, prefixes, own[at], other, limit), _less(buffer, prefixes, other, own[at], limit))
            low[at], high[at] = np.where(before, middle + 1, low[at]), np.where(before, high[at], middle)
        place = base + pair + (i - np.where(right, pair + run, pair)) + (low - sister)
        moved = order.copy()
        moved[place] = order[active]
        order = moved
        run *= 2
    return order


def _by_first_bytes(buffer: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups split by the first eight bytes of their strings, numbered in that order, and their sizes."""
    lead = np.zeros(len(start), _U)
    if length >= 8 and len(start):
        lead = np.ndarray(len(buffer) - 7, ">u8", buffer.data, strides=(1,))[start].astype(_U)
    order = np.lexsort((lead, group))
    new = (group[order][1:] != group[order][:-1]) | (lead[order][1:] != lead[order][:-1])
    split = np.empty(len(order), np.int64)
    split[order] = np.cumsum(np.append(False, new)[: len(order)])
    return split, np.bincount(split)


def _sorted_repeats(buffer: np.ndarray, prefixes: Prefixes, r: np.ndarray, b: np.ndarray, anchor: np.ndarray, length: int) -> tuple:
    """Records and starts of the strings that also start earlier, by sorting all strings of some anchors."""
    n = r["strings"].astype(np.int64)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start, w = np.repeat(b, n) + inner, np.repeat(r, n)
    at = w["at"] + inner
    group = np.repeat(anchor, n) * (length + 1) + (w["ahead"] - inner)
    group, counts = _by_first_bytes(buffer, start, group, length)
    several = counts[group] > 1
    start, w, at, group = start[several], w[several], at[several], group[several]
    early = np.lexsort((at, w["doc"]))
    start, w, at, group = start[early], w[early], at[early], group[early]
    order = sort_suffixes(buffer, prefixes, start, group, length)
    if not len(order):
        return w, at
    same = np.zeros(len(order) - 1, bool)
    near = np.flatnonzero(group[order][1:] == group[order][:-1])
    near = near[common_extension(prefixes, start[order[near]], start[order[near + 1]], length) == length]
    same[near] = _equal_bytes(buffer, start[order[near]], start[order[near + 1]], length)  # collisions
    # The sort is stable over (doc, start): a run's first is its earliest.
    lead = np.flatnonzero(np.append(True, ~same))
    lead = np.repeat(lead, np.diff(np.append(lead, len(order))))
    w, at = w[order], at[order]
    earlier = (w["doc"][lead] < w["doc"]) | ((w["doc"][lead] == w["doc"]) & (at[lead] < at))
    return w[earlier], at[earlier]


def _repeated_in_shard(records: np.ndarray, data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, key, start) of the strings that also start earlier."""
    out = [[], [], []]

    def report(r: np.ndarray, at: np.ndarray) -> None:
        for o, v in zip(out, (r["doc"], r["key"], at)):
            o.append(v.astype(np.int64))

    def report_all(r: np.ndarray) -> None:
        n = r["strings"].astype(np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        whole = np.repeat(r, n)
        report(whole, whole["at"] + inner)

    report_all(records[records["size"] == 0])
    records = records[records["size"] > 0]
    if not len(records):
        return tuple(np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
    buffer = np.frombuffer(data, np.uint8)
    prefixes = Prefixes(buffer)
    begin = np.cumsum(records["size"].astype(np.int64)) - records["size"]

    # Equal surroundings: all but the earliest are repeated whole.
    size = records["size"].astype(np.int64)
    whole = prefixes.of(begin, begin + size)
    order = np.lexsort((records["at"], records["doc"], size, records["ahead"], whole))
    s = records[order]
    same = (whole[order][1:] == whole[order][:-1]) & (s["ahead"][1:] == s["ahead"][:-1]) & (s["size"][1:] == s["size"][:-1])
    single = np.flatnonzero(same & (s["size"][1:] == length))  # verified by their bytes
    same[single] = _equal_bytes(buffer, begin[order[single]], begin[order[single + 1]], length)
    for i in np.flatnonzero(same & (s["size"][1:] != length)):
        a, b, n = begin[order[i]], begin[order[i + 1]], size[order[i]]
        same[i] = data[a : a + n] == data[b : b + n]
    lead = np.flatnonzero(np.append(True, ~same))
    lead = np.repeat(lead, np.diff(np.append(lead, len(s))))
    earlier = (s["doc"][lead] < s["doc"]) | ((s["doc"][lead] == s["doc"]) & (s["at"][lead] < s["at"]))
    report_all(s[earlier])
    rest = order[~earlier]

    # Different surroundings of the same anchor: every string, sorted as a suffix.
    r, b = records[rest], begin[rest]
    anchor = prefixes.of(b + r["ahead"], b + r["ahead"] + gram)
    _, inverse, counts = np.unique(anchor, return_inverse=True, return_counts=True)
    several = counts[inverse] > 1
    order = np.flatnonzero(several)[np.argsort(inverse[several], kind="stable")]
    r, b, inverse = r[order], b[order], inverse[order]
    held = np.cumsum(r["strings"].astype(np.int64))
    a = 0
    while a < len(r):  # whole anchors, of a bounded number of strings together
        z = int(np.searchsorted(held, (held[a - 1] if a else 0) + SORTED, side="right"))
        z = int(np.searchsorted(inverse, inverse[min(max(z, a + 1), len(r)) - 1], side="right"))
        report(*_sorted_repeats(buffer, prefixes, r[a:z], b[a:z], inverse[a:z], length))
        a = z
    return tuple(np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)


def found_spans(sent: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, key, spans): byte spans to remove, found by one shard, as pairs of 32-bit numbers."""

    def decide(shard: pa.Table) -> pa.Table:
        records = np.concatenate([np.frombuffer(r.as_buffer(), _CONTEXT) for r in shard["records"]])
        data = b"".join(shard["data"].to_pylist())
        doc, key, at = _repeated_in_shard(records, data, length, gram)
        if not len(doc):
            return _SPANS.empty_table()
        order = np.lexsort((at, key, doc))
        doc, key, at = doc[order], key[order], at[order]
        own = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))
        new = np.flatnonzero(own | np.append(True, np.diff(at) > length))
        last = np.append(new[1:], len(at)) - 1
        spans = np.stack([at[new], at[last] + length], 1).astype("<u4")
        cuts = np.flatnonzero(own[new])
        ends = np.append(cuts[1:], len(new))
        found = pa.array([spans[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
        return pa.table([doc[new[cuts]], key[new[cuts]], found], schema=_SPANS)

    return sent.groupBy("shard").applyInArrow(decide, "doc long, key long, spans binary")


def merged_spans(parts: Iterable[bytes]) -> np.ndarray:
    """Spans of one document from all shards, overlapping and touching ones joined."""
    spans = np.concatenate([np.frombuffer(p, "<u4").reshape(-1, 2).astype(np.int64) for p in parts])
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]], 1)


def _whole_characters(data: bytes, spans: np.ndarray) -> str:
    """The text without the spans, which are first shrunk to whole characters."""
    kept, at = [], 0
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    for a, b in spans.tolist():
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        if a < b:
            kept.append(data[at:a])
            at = b
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False, hot: int = HOT, carry: Sequence[str] = ()
) -> DataFrame:
    """Remove repeated passages from all rows of ``docs`` (doc_id, text).

    Returns per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes); with ``texts`` also text, what remains
    when the removed runs are shrunk to whole characters; last, as "__<name>",
    any columns of ``docs`` named in ``carry``, unchanged. Null texts are empty. A null doc_id comes after all others. Rows
    with the same doc_id count as one document: of rows repeated whole none
    repeats the other. An empty table gives an empty table; other columns are
    not looked at.
    """
    extra = [f"__{c}" for c in carry]
    given = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
        *[docs[f"`{c}`"].alias(e) for c, e in zip(carry, extra)],
    ).withColumn("key", F.xxhash64("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(MIN_SHARDS, size // SHARD_BYTES)
    sha = F.sha2(F.col("text").cast("binary"), 256)

    # The smallest id of each text, and the rows that come after it.
    narrow = materialise(given.select("doc", "key", sha.alias("sha")))
    firsts = materialise(narrow.groupBy("sha").agg(F.min("doc").alias("first"), F.min("key").alias("key"), F.count("*").alias("n")))
    copies = narrow.join(firsts.filter("n > 1").select("sha", "first"), "sha").filter("doc > first").select("doc", "key").distinct()

    places = repeated_anchors(anchor_table(given, shards, length, gram), hot).groupBy("key").agg(F.collect_list("places").alias("places"))
    marked = materialise(firsts.select(F.col("first").alias("doc"), "key").join(places, "key").select("doc", "key", "places"))
    by_doc = given.select("doc_id", "doc", "key", "text", *extra)
    joined = by_doc.join(marked.hint("shuffle_hash"), ["doc", "key"])
    spans = found_spans(surroundings(joined, shards, length, gram), length, gram).groupBy("doc", "key").agg(F.collect_list("spans").alias("spans"))
    found = materialise(
        spans.withColumn("copy", F.lit(False)).unionByName(copies.select("doc", "key", F.array().cast("array<binary>").alias("spans"), F.lit(True).alias("copy")))
    )
    columns = T.StructType().add("doc_id", "long").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    if texts:
        columns, kinds = columns.add("text", "string"), [*kinds, pa.string()]
    for c, e in zip(carry, extra):
        columns = columns.add(e, docs.schema[c].dataType)
    names = columns.names

    def cut(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(stream):
            out = [[] for _ in kinds]
            at = [b.column(b.schema.get_field_index(n)).to_pylist() for n in ("doc_id", "text", "spans", "copy")]
            for doc_id, text, spans, copy in zip(*at):
                data = text.encode("utf-8", "replace")
                if copy and len(data) >= length:
                    gone = np.array([[0, len(data)]])
                elif spans:
                    gone = merged_spans(spans)
                else:
                    gone = np.zeros((0, 2), np.int64)
                edges = [0, *gone.ravel().tolist(), len(data)]
                kept = b"".join(data[a:e] for a, e in zip(edges[::2], edges[1::2]))
                row = [doc_id, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()]
                if texts:
                    row.append(_whole_characters(data, gone))
                for o, v in zip(out, row):
                    o.append(v)
            carried = [b.column(b.schema.get_field_index(e)) for e in extra]
            yield pa.RecordBatch.from_arrays([*(pa.array(o, k) for o, k in zip(out, kinds)), *carried], names=names)

    return by_doc.join(found.hint("shuffle_hash"), ["doc", "key"], "left").mapInArrow(cut, columns)

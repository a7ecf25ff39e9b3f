"""Runs against brute force."""

import numpy as np
import pytest

from formweave.llm import periodic
from formweave.llm.periodic import Extensions, find_runs, periodic_runs
from formweave.llm.queries import op12_periodic_runs, with_planted_runs


def brute(words, least=24, repeats=3):
    """All runs by trying every period, smallest first."""
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        a = 0
        while a + q < n:
            b = a
            while b + q < n and words[b] == words[b + q]:
                b += 1
            if b + q - a >= max(least, repeats * q):
                out.setdefault((a, b + q - a), q)
            a = max(b, a) + 1
    return sorted((s, m, q) for (s, m), q in out.items())


def collapsed(words, runs):
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def sequences():
    random = np.random.default_rng(3)
    for size in (0, 1, 23, 24, 25, 60, 130, 400):
        for letters in (1, 2, 3, 30):
            yield random.integers(0, letters, size).tolist()
    for _ in range(12):
        unit = random.integers(0, 4, random.integers(1, 20)).tolist()
        yield random.integers(0, 4, 17).tolist() + unit * int(random.integers(2, 15)) + unit[:3] + random.integers(0, 4, 30).tolist()
    nested = ([1, 2] * 14 + [3]) * 4
    yield nested + nested[:20]


def test_extensions_against_plain_comparison():
    random = np.random.default_rng(8)
    for values in (random.integers(0, 2, 300), np.zeros(200, np.int64), np.tile(random.integers(0, 5, 40), 9)):
        values = np.append(values, 99)
        ext = Extensions(values)
        i = random.integers(0, len(values), 2000)
        j = random.integers(0, len(values), 2000)
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i, j):
            n = 0
            while max(a, b) + n < len(values) and values[a + n] == values[b + n]:
                n += 1
            want.append(n)
        assert ext.of(i, j).tolist() == want


@pytest.mark.parametrize("pairs", [1 << 19, 7])
def test_runs_against_brute_force(pairs, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_PAIRS", pairs)
    texts = list(sequences())
    starts, values = [], []
    for i, t in enumerate(texts):
        starts.append(len(values))
        values += [v + 1000 for v in t] + [i]
    starts, lengths = np.array(starts), np.array([len(t) for t in texts])
    got = find_runs(np.array(values), starts, lengths)
    want = [(s + a, m, q) for t, a in zip(texts, starts) for s, m, q in brute(t)]
    assert [tuple(r) for r in got.tolist()] == want
    assert len(want) > 20


def test_texts_against_brute_force(spark):
    texts = [" ".join(f"w{v}" for v in t) for t in sequences()]
    texts += ["a b " * 30, "  \t lead " * 40, "x\x0by\x0c" * 50, None, "", " \n ", "日本 " * 25, " ".join("ab" * 20)]
    rows = [(i, t, "z", 5, [1]) for i, t in enumerate(texts)] + [(None, "again " * 24, None, 0, None), (3, "a b " * 20, "", 1, None), (3, "a b " * 20, "", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int, collapsed array<int>").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    want = []
    for i, t, *_ in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = brute(words)
        want.append((-1 if i is None else i, len(words), runs, collapsed(words, runs)))
    assert got == sorted(want)
    assert periodic_runs(docs.limit(0)).count() == 0


def test_long_text(spark):
    """One text of 300,000 words with runs of very long and very short periods."""
    random = np.random.default_rng(4)
    unit = random.integers(0, 5000, 60_000).tolist()
    words = random.integers(0, 5000, 20_000).tolist() + unit * 3 + [7] * 100_000
    docs = spark.createDataFrame([(1, " ".join(map(str, words)))], "doc_id long, text string")
    row = periodic_runs(docs).first()
    found = {(r.length, r.period) for r in row.runs}
    assert row.n_words == 300_000 and any(m >= 180_000 and q == 60_000 for m, q in found) and any(m >= 100_000 and q == 1 for m, q in found)
    assert len(row.collapsed.split()) <= 300_000 - 120_000 - 99_998


def test_query_repeats_words(spark):
    """Every tenth text, by its id, is changed as told; a null id or text is left alone."""
    import zlib

    random = np.random.default_rng(5)
    rows = [(i, " ".join(map(str, random.integers(0, 9, random.integers(0, 90))))) for i in range(300)] + [(None, "a b"), (17, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in with_planted_runs(docs).collect()}
    want = set()
    for i, t in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        w = (t or "").split()
        if h % 10 == 0 and t is not None:
            if w:
                g, n = h // 10, len(w)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = " ".join(w[k if k < a else a + (k - a) % p] for k in range(n))
            else:
                t = ""
        want.add((i, t))
    assert {(i, t or "") for i, t in got} == {(i, t or "") for i, t in want}


def test_query_on_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_periodic_runs(spark, str(tmp_path)).count() == 0

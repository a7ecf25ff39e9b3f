"""The language model: exact counts, proper probabilities, better than the base."""

import math
import os
import zlib
from collections import Counter

import numpy as np

from formweave.llm import pitman_yor
from formweave.llm.pitman_yor import CONTEXTS, Model, Shard, Totals, probabilities, score_language, seat, sweeps, words_of
from formweave.session import shared_dir


def base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [words_of(t or "") for _, t in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, _), t, h in zip(rows, tokens, held):
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((-1 if i is None else i, h, len(t), sum(counts[w] > 0 for w in t), n, round(score, 6)))
    return sorted(out)


def found(frame):
    rows = frame.collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scored = score_language(docs.repartition(3)).persist()
    assert found(scored) == base(rows)
    held = scored.filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held.s > held.b
    again = {r.doc_id: r.score for r in score_language(docs.repartition(5)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-3 * abs(r.score) for r in scored.collect())


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "A a\x00b É é"), (3, "A a\x00b É é"), (None, "a"), (4, "word " * 70000), (5, "x y z")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    assert found(score_language(docs)) == base(rows)
    assert score_language(docs.limit(0)).count() == 0


def small():
    """All words in all contexts, and one word never seen."""
    picks = np.random.default_rng(3)
    words, contexts = 30, 4
    count = picks.integers(0, 3, (words, contexts)) * picks.integers(0, 60, (words, contexts))
    count[0] += 1
    grid = np.append(count, np.zeros((1, contexts), int), 0)
    word, context = (a.ravel() for a in np.meshgrid(np.arange(words + 1), np.arange(contexts), indexing="ij"))
    shard = Shard(word, context, grid.ravel(), words + 1, [], [])
    customers = np.zeros(CONTEXTS)
    customers[:contexts] = grid.sum(0)
    model = Model(customers, int(grid.sum()), int((grid.sum(1) > 0).sum()), 0.7, 0.6)
    tables = np.bincount(context, weights=grid.ravel() > 0, minlength=CONTEXTS)
    model.totals = [Totals(tables, float((grid > 0).sum()), float(model.words))]
    for n in (1, 2, 3):
        for _, t, c, p in sweeps(shard, model, n):
            pass
        model.totals.append(Totals(np.bincount(context, weights=t, minlength=CONTEXTS), float(c.sum()), float(p.sum())))
    return shard, model, contexts, grid


def test_probabilities_add_to_one():
    shard, model, contexts, grid = small()
    p = probabilities(shard, model)
    never = np.flatnonzero(grid.sum(1) == 0)
    for context in range(contexts):
        own = p[shard.context == context].copy()
        own[never[:-1]] = 0  # words never seen are one symbol
        assert abs(own.sum() - 1) < 1e-9


def test_tables_follow_their_distribution():
    """Tables of one block against exact probabilities by recursion over the customers."""
    count, rest, p, concentration, discount = 60, 5, 0.3, 1.0, 0.5
    chance = {1: 1.0}
    for seated in range(1, count):
        after = Counter()
        for t, q in chance.items():
            new = (concentration + discount * (rest + t)) * p
            total = seated - discount * t + new
            after[t + 1] += q * new / total
            after[t] += q * (total - new) / total
        chance = after
    n = 20000
    drawn, _ = seat(np.full(n, count), np.full(n, rest), np.full(n, p), concentration, discount, np.random.default_rng(1))
    for t, q in chance.items():
        assert abs((drawn == t).mean() - q) < 4 * math.sqrt(q / n) + 2e-3


def test_every_previous_word_is_a_context(spark):
    """Words of one ending and length were one context: the word after them could not be told."""
    names = [f"{a}{b}axyz" for a in "bcdfghjklm" for b in "bcdfghjklm"]
    texts = [f"{n} then{i % 2}" for i, n in enumerate(names)] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = [i for i in range(10000, 12000) if zlib.crc32(str(i).encode()) % 5 == 1][: len(names)]
    swapped = spark.createDataFrame([(h, f"{n} then{1 - i % 2}") for i, (h, n) in enumerate(zip(held, names))], docs.schema)
    scored = score_language(docs.union(swapped)).filter("held_out").collect()
    right = [r.score for r in scored if r.doc_id < 10000]
    wrong = [r.score for r in scored if r.doc_id >= 10000]
    assert len(wrong) == len(names) and min(right) > max(wrong) + 0.2 and np.mean(right) > np.mean(wrong) + 0.5


def test_only_scores_are_left(spark):
    """Copies of the pairs, totals and answers stayed in the shared folder, and shards were merged in every pass."""
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(shared_dir(spark)) for f in fs}
    rows = [(i, f"w{i % 7} and then w{i % 11}") for i in range(200)]
    before = files()
    scored = score_language(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    left = {os.path.dirname(f) for f in files() - before}
    assert len(left) == 1 and {r.doc_id for r in spark.read.parquet(left.pop()).collect()} == set(range(200))
    assert found(scored) == base(rows) and not [t for t in spark.catalog.listTables() if t.name.startswith("formweave_")]


def test_each_sweep_goes_on_from_the_last():
    """One sweep from a given seating is what all sweeps run from the start come to."""
    shard, model, _, _ = small()
    last, seatings = None, []
    for s, *shown in sweeps(shard, model, 3):
        last = pitman_yor.sweep(shard, model, s, last)
        assert all(np.array_equal(a, b) for a, b in zip(shown, last.shown(shard)))
        seatings.append((s, *shown))
    assert np.array_equal(probabilities(shard, model, seatings[1:]), probabilities(shard, model))


def test_distinct_keys():
    picks = np.random.default_rng(4)
    for size, bound in ((0, 9), (1, 1), (5000, 700), (5000, 1 << 49), (5000, 1 << 62)):
        keys = picks.integers(0, bound, size)
        keys = np.append(keys, keys[: size // 3])
        values, at = np.unique(keys, return_inverse=True)
        got, of_key = pitman_yor._distinct(keys.copy(), bound)
        assert np.array_equal(got, values) and np.array_equal(of_key, at)

"""Counting quotient filters, and groups of equal texts against a plain count."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from formweave.llm.exact_dedup import decode, encode, exact_groups, merge


@pytest.mark.parametrize("bits", [4, 20, 40, 60, 64])
def test_filters_keep_every_value_and_count(bits):
    picks = np.random.default_rng(bits)
    for size in (0, 1, 2, 3, 100, 1000):
        values = np.unique(picks.integers(0, 1 << bits, size, dtype=np.uint64) if bits < 64 else picks.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        counts = picks.integers(1, 5, len(values)).astype(np.uint64) ** np.uint64(9)
        got = decode(encode(values, counts, bits))
        assert (got[0] == values).all() and (got[1] == counts).all()


def test_merging_loses_nothing():
    picks = np.random.default_rng(1)
    want, filters = Counter(), []
    for _ in range(5):
        values, counts = np.unique(picks.integers(0, 3000, 2000, dtype=np.uint64), return_counts=True)
        want.update(dict(zip(values.tolist(), counts.tolist())))
        filters.append(encode(values, counts.astype(np.uint64), 40))
    values, counts = merge(filters)
    assert dict(zip(values.tolist(), counts.tolist())) == dict(want)


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, "x"), (3, "x "), (4, "x"), (4, "x"), (None, "x"), (None, "y"), (5, "é" * 50000), (6, "é" * 50000)]
    rows += [(100 + i, "hot") for i in range(500)]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, keep_id long")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t in rows:
        own = groups[t or ""]
        keep = max((j for j in own if j is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    order = lambda x: sorted(x, key=str)
    assert order(map(tuple, exact_groups(docs.repartition(4)).collect())) == order(want)
    assert exact_groups(docs.limit(0)).count() == 0

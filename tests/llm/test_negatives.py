"""Hard negatives against brute force."""

import math

import numpy as np
import pytest

from formweave.llm import negatives
from formweave.llm.negatives import Block, best_in_windows, best_of_label, mine_negatives


def brute(rows, every=100, k=5, n=10):
    used = []
    for i, v, label in dict.fromkeys((i, tuple(v) if v is not None else None, lab) for i, v, lab in rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) or abs(256 * x) > 1 << 26 for x in v):
            continue
        used.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, v, label in used:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, lab) for j, w, lab in used)
        for s, j, _ in [r for r in scored if r[2] == label and r[1] != i][:k]:
            fit = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:n]
            out += [(i, j, at + 1, r[1], -s, -r[0]) for at, r in enumerate(fit)]
    return sorted(out)


def mined(frame):
    return sorted(tuple(r) for r in frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(6)
    centres = random.normal(size=(4, 12))
    out = []
    for i in range(900):
        label = int(random.integers(0, 4))
        v = (centres[label] + random.normal(size=12)) * 0.3
        out.append((i, np.float32(v).astype(float).tolist(), label))
    hot = out[500][1]
    return [(i, hot if i % 3 == 0 else v, 1 if i % 3 == 0 else lab) for i, v, lab in out]


@pytest.mark.parametrize("block", [negatives.BLOCK, 70])
def test_against_brute_force(spark, rows, block, monkeypatch):
    """A third of the rows share one vector and one label, and tie."""
    monkeypatch.setattr(negatives, "BLOCK", block)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = mined(mine_negatives(table, every=50))
    want = brute(rows, every=50)
    assert got == want and len(want) > 300


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [0.0, 0.0], 2), (200, [-1.0, 0.2], 1), (300, [1.0], 2), (400, [], 1), (500, [0.5, 0.5, 0.5], 2)]
    rows += [(1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 2), (5, [1e300, 1.0], 2), (None, [1.0, 1.0], 1), (6, [1.0, 1.0], None)]
    rows += [(7, [0.9, 0.4], 1), (7, [0.9, 0.4], 1), (7, [0.2, 0.9], 2), (0, [0.3, 0.3], 2), (8, [0.7, 0.3], 2), (9, [0.6, 0.3], 2)]
    given = [(i, v, lab, "x", 1) for i, v, lab in rows]
    table = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int, key string, unit int").repartition(3)
    assert mined(mine_negatives(table)) == brute(rows)
    assert mine_negatives(table.limit(0)).count() == 0
    assert mine_negatives(table.filter("label IS NULL")).count() == 0
    assert mine_negatives(table.filter("vec_id = 7")).count() == 0


def test_scan_is_exact_for_large_components():
    """Sums beyond 2^53 are summed as whole numbers."""
    random = np.random.default_rng(2)
    matrix = random.integers(-(1 << 26), 1 << 26, (200, 40))
    block = Block.of(np.arange(200), np.arange(200) % 2, matrix)
    vector = random.integers(-(1 << 26), 1 << 26, 40)
    exact = [sum(int(a) * int(b) for a, b in zip(vector, r)) for r in matrix]
    ids, score = best_of_label(block, 0, 0, vector, 5)
    want = sorted((-exact[i], i) for i in range(2, 200, 2))[:5]
    assert list(zip((-score).tolist(), ids.tolist())) == want
    top = -want[0][0]
    (found, values), (none, _) = best_in_windows(block, 0, vector, [(-top, top), (5, 4)], 7)
    fit = sorted((-exact[i], i) for i in range(1, 200, 2) if -top <= exact[i] <= top)[:7]
    assert list(zip((-values).tolist(), found.tolist())) == fit and len(none) == 0

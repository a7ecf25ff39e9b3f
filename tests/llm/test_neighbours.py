"""Learned partitions against brute force."""

import numpy as np

from formweave.llm.neighbours import Router, balanced_parts, learn_below, learn_partitions, nearest, neighbour_graph, parts_to_visit, visits_for


def brute(ids, rows, k, step):
    out = {}
    for q, v in zip(ids, rows):
        if q % step == 0:
            score = (rows * v).sum(1)
            order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
            out[int(q)] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    d = table.toPandas()
    want = brute(d.vec_id.to_numpy(), np.array(d.embedding.tolist(), float), 20, 20)
    got = found(nearest(table))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    exact = {q: dict(v) for q, v in want.items()}
    assert all(abs(s - exact[q][i]) < 1e-12 for q, v in got.items() for i, s in v if i in exact[q])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20 * i, [1.0, float(i)], 0) for i in range(3)]
    rows += [(1, [1.0, 1.0], 0), (2, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0)]
    rows += [(60, [nan, 1.0], 0), (80, [inf, 1.0], 0), (None, [1.0, 1.0], 0), (100, [1.0], 0), (100, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    good = [r for r in rows if r[0] in (0, 20, 40, 1, 2)]
    want = brute(np.array([r[0] for r in good]), np.array([r[1] for r in good]), 3, 20)
    assert found(nearest(table, k=3)) == want
    assert nearest(table.limit(0)).count() == 0
    assert nearest(table.filter("vec_id = 3")).count() == 0


def test_parts_are_balanced():
    rows = np.random.default_rng(0).normal(size=(600, 8))
    part = balanced_parts(rows, neighbour_graph(rows), 6)
    assert np.bincount(part).max() <= 110


def recall(table, ids, rows, parts, most=256):
    want, got = brute(ids, rows, 20, 20), found(nearest(table, parts=parts, most=most))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    # Equal scores are equally near: a copy may stand for another.
    return sum(sum(s >= want[q][-1][1] for _, s in got[q]) for q in want) / (20 * len(want))


def test_recall_where_few_parts_are_visited(spark):
    """Clustered vectors, and the same with a third of the rows alike: most parts are never looked at."""
    random = np.random.default_rng(4)
    centres = random.normal(size=(80, 24))
    clustered = centres[random.integers(0, 80, 6000)] + 0.35 * random.normal(size=(6000, 24))
    clustered /= np.linalg.norm(clustered, axis=1, keepdims=True)
    skewed = clustered.copy()
    skewed[random.random(6000) < 1 / 3] = clustered[0]
    ids = np.arange(6000)
    for rows in (clustered, skewed):
        assert learn_partitions(rows[::2], 32, 20, 0.95).visits < 8
        table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, rows)], "vec_id long, embedding array<double>")
        assert recall(table, ids, rows, 32) >= 0.9
        assert recall(table, ids, rows, 32, most=8) >= 0.9


def test_parts_cut_again(spark):
    """Two levels of networks: as many parts as asked for, most of them never looked at."""
    random = np.random.default_rng(6)
    rows = random.normal(size=(60, 16))[random.integers(0, 60, 5000)] + 0.3 * random.normal(size=(5000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    top = learn_partitions(rows[:3000], 6, 20, 0.95)
    tree = learn_below(table, top, 16, 5, 5000, rows[:100])
    assert tree.parts == 30 and visits_for(tree, rows[:3000], 20, 0.95) < 10
    home = tree.home(rows)
    assert np.array_equal(np.searchsorted(np.arange(0, 30, 5), home, side="right") - 1, top.home(rows))
    assert np.bincount(home, minlength=30).max() < 2 * 5000 / 6
    assert np.allclose(np.exp(tree.logits(rows[:50])).sum(1), 1)


def test_parts_until_enough_are_held():
    router = Router(np.eye(3), np.zeros(3), np.eye(3), np.zeros(3), 1.0)
    rows = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])
    row, part = parts_to_visit(router, rows, np.array([4, 0, 9]), 5)
    assert list(zip(row.tolist(), part.tolist())) == [(0, 0), (0, 2), (1, 2)]
    row, part = parts_to_visit(router, rows, np.array([4, 0, 9]), 99)
    assert list(zip(row.tolist(), part.tolist())) == [(0, 0), (0, 2), (1, 2), (1, 0)]

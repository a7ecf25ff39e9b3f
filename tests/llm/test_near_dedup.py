"""Near-duplicate classes against all pairs."""

import hashlib

import numpy as np

from formweave.llm.near_dedup import _WordHashes, chain, labelled_shingles, near_classes, similarity, words_of


def brute(rows):
    """Smallest connected id of every row, over all pairs."""
    last = 1 << 63
    rows = [(last if i is None else i, t or "") for i, t in rows]
    hashes = _WordHashes()
    x = [labelled_shingles(words_of(t), hashes) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = words_of(rows[i][1]) == words_of(rows[j][1]) if len(x[i]) else rows[i][1] == rows[j][1]
            if same or similarity(x[i], x[j]) >= 0.8 - 1e-12 or rows[i][0] == rows[j][0]:
                up[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), last), doc)
    return sorted((doc, low[root(i)]) for i, (doc, _) in enumerate(rows))


def found(classes):
    last = 1 << 63
    return sorted((last if r.doc_id is None else r.doc_id, last if r.class_id is None else r.class_id) for r in classes.collect())


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    classes, links = near_classes(docs)
    assert found(classes) == brute(rows)
    assert links.count() > 0


def test_group_of_edits(spark):
    """A large group around one text: many pairs are below the threshold."""
    picks = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(picks.integers(0, 7)):
            words[picks.integers(0, len(words))] = f"x{picks.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    classes, _ = near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found(classes) == brute(rows)


def test_edges(spark):
    long = " ".join(f"word{i}" for i in range(20000))
    rows = [(0, None), (1, ""), (2, "!"), (3, "?"), (4, "?"), (5, "one two"), (6, "One, two!"), (7, "two one"), (8, long), (9, long + " more")]
    rows += [(None, long), (10, "a a a a a a a a"), (11, "a a a a a a a a a"), (5, "one two"), (12, "b " * 300), (13, "b " * 299)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id int")
    classes, _ = near_classes(docs)
    assert found(classes) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in classes.filter("doc_id is not null").collect())
    assert near_classes(docs.limit(0))[0].count() == 0


def shared_ids():
    """Rows without an id, and rows of one id, of which some are near copies of other rows."""
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"]
    near = [t + " more" for t in texts]
    rows = [(1, texts[0]), (2, texts[1]), (None, near[0]), (None, texts[2]), (None, near[2]), (7, near[1]), (7, texts[3]), (8, near[3]), (8, texts[4]), (9, texts[5])]
    one = min((texts[2], near[2]), key=lambda t: hashlib.sha256(t.encode()).digest())
    kept = {(1, texts[0]), (2, texts[1]), (None, one), (7, texts[3]), (8, texts[4]), (9, texts[5])}
    low = {near[0]: 1, near[1]: 2, near[3]: 7}
    return rows, kept, low


def test_rows_sharing_ids(spark):
    rows, kept, low = shared_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes, _ = near_classes(docs, with_key=True)
    text_of = {hashlib.sha256(t.encode()).digest()[:16]: t for _, t in rows}
    got = {(r.doc_id, text_of[bytes(r.key)]): (r.class_id, r.kept) for r in classes.collect()}
    assert got == {(i, t): (low.get(t, i), (i, t) in kept) for i, t in rows}


def test_chain_against_dynamic_programming():
    picks = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.array(picks.permutation(12)[: picks.integers(1, 12)], np.uint64) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert chain(a, b, 0) == best[-1, -1]
        wanted = similarity(a, b, 0.5) >= 0.5
        assert wanted == (best[-1, -1] / (len(a) + len(b) - best[-1, -1]) >= 0.5)

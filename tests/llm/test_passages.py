"""Repeated passages against a plain scan over all strings."""

import hashlib

import numpy as np
import pytest

from formweave.llm.passages import Prefixes, remove_repeats, sort_suffixes


def brute(rows, length=100):
    """Every string of every text, in order of (doc_id, start)."""
    last = 1 << 63
    firsts, out = {}, []
    rows = sorted(((last if i is None else i, (t or "").encode()) for i, t in rows))
    for doc, data in rows:
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            firsts[s] = min(firsts.get(s, (doc, p)), (doc, p))
    for doc, data in rows:
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if firsts[data[p : p + length]] < (doc, p):
                gone[p : p + length] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(frame):
    return sorted((1 << 63 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


@pytest.mark.parametrize("hot", [2000, 3])
def test_given_documents(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(remove_repeats(docs.repartition(4), hot=hot)) == brute(rows)


def test_edges(spark):
    picks = np.random.default_rng(2)
    word = lambda n: "".join(chr(97 + c) for c in picks.integers(0, 26, n))
    passage, other = word(150), "é" * 60 + word(40)
    rows = [(0, None), (1, ""), (2, "a" * 400), (3, "ab" * 300), (4, word(50) + passage + word(9)), (5, passage + other)]
    rows += [(6, word(3) + other[5:] + passage[1:120]), (7, word(99)), (8, word(100))]
    rows += [(9, rows[8][1]), (10, rows[7][1]), (None, passage), (5, passage + other), (11, passage[:99]), (12, "x" + passage[10:109] + "x")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    assert found(remove_repeats(docs)) == brute(rows)
    assert found(remove_repeats(docs, hot=1)) == brute(rows)
    assert remove_repeats(docs.limit(0)).count() == 0
    kept = {r.doc_id: r.text for r in remove_repeats(docs, texts=True).filter("doc_id < 5 or doc_id > 5").collect()}
    assert kept[8] == rows[8][1] and kept[9] == "" and "�" not in kept[6]


def test_passage_in_most_texts(spark):
    """A frequent passage with other words around it everywhere, and one id with several texts."""
    picks = np.random.default_rng(8)
    word = lambda n: "".join(chr(97 + c) for c in picks.integers(0, 26, n))
    passage, tail = word(220), word(60)
    rows = [(int(i), word(int(picks.integers(0, 40))) + passage + (tail if i % 3 else "") + word(30)) for i in picks.permutation(60)]
    rows += [(7, word(5) + passage), (7, word(5) + passage), (30, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hot in (2000, 20, 0):
        assert found(remove_repeats(docs, hot=hot)) == brute(rows)


def test_suffix_sort():
    picks = np.random.default_rng(4)
    buffer = picks.integers(97, 99, 600).astype(np.uint8)
    starts = picks.permutation(500)
    groups = picks.integers(0, 3, 500)
    order = sort_suffixes(buffer, Prefixes(buffer), starts, groups, 12)
    data = buffer.tobytes()
    keys = [(g, data[s : s + 12]) for g, s in zip(groups, starts)]
    assert [keys[i] for i in order] == sorted(keys)

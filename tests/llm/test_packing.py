"""Packing: every id in exactly one piece, gapless windows, little padding."""

import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from formweave.llm.packing import VOCABULARY, nonnegative_least_squares, pack_documents, plan_windows


def check(docs, rows, window=2048):
    library = Tokenizer.from_file(VOCABULARY)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
    assert set(by_doc) == set(ids)
    for own in by_doc.values():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == own[0].doc_tokens
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += window - at
    return padding / (window * len(by_sequence))


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert check(texts, pack_documents(docs.repartition(5)).collect()) < 0.01


def test_edges(spark):
    texts = [(0, None), (1, ""), (2, "x <|endoftext|> y"), (3, "word " * 30000), *((i, "one two three " * 100) for i in range(4, 60))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int")
    assert check(texts, pack_documents(docs).collect()) < 0.05
    assert pack_documents(docs.limit(0)).count() == 0


def test_solver_and_plan():
    a = np.array([[1.0, 0, 1], [0, 1, 1], [1, 1, 0]])
    x = nonnegative_least_squares(a, np.array([3.0, 2, 1]))
    assert np.allclose(a @ x, [3, 2, 1]) and (x >= 0).all()
    plan = plan_windows({5: 10, 3: 10, 2: 10, 8: 4, 1: 7}, 8)
    used = defaultdict(int)
    for repeats, combination in plan:
        assert sum(combination) == 8
        for c in combination:
            used[c] += repeats
    assert used[5] == 10 and used[3] >= 9 and used[8] == 4


def test_tokenizer_holds_few_new_pieces_at_once(monkeypatch):
    from formweave.llm import packing

    tool, sizes = packing.Tokenizer(packing.VOCABULARY), []
    texts = [" ".join(f"w{i}x{j}" for j in range(3000)) for i in range(6)] + ["", "é w0x1"]
    expected = tool._direct(texts)
    direct = tool._direct
    monkeypatch.setattr(tool, "_direct", lambda some: sizes.append(len(some)) or direct(some))
    assert list(tool.encode(texts)) == expected
    assert max(sizes) <= packing.NEW_PIECES < sum(sizes)

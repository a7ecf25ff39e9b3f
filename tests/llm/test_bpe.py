"""The encoder against the library that defines the ids, and the round trip."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from formweave.llm.bpe import codec, decode_ids, encode_texts, round_trip

NAMES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    path = public_tokenizers.path(request.param)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return codec(path), library


def test_odd_texts(both):
    ours, library = both
    picks = random.Random(3)
    alphabet = "aabbeehtnsr   ''stm\n\t\r\x0b\x1c\x1d\x85\xa0 　éèßüñÉ0123٣½ⅷ.,!?#_-漢字ひらがな한글אبд😀🇩🇪́﻿\x00"
    texts = ["", " ", "a" * 3000, "ab" * 2000, " " * 500 + "x", "\n\n\n a\n \n", "<|endoftext|>", "'s 't 're' 'LL"]
    texts += ["".join(picks.choice(alphabet) for _ in range(picks.randint(1, 200))) for _ in range(1500)]
    for text in texts:
        assert ours.encode(text) == library.encode_ordinary(text), repr(text)
        assert ours.decode(ours.encode(text)) == text.encode()


def test_random_letters(both):
    ours, library = both
    picks = random.Random(5)
    for letters in ("etaoin", "abcdefghijklmnopqrstuvwxyz", "aab", "éàüß", "漢字仮名交じり文"):
        for _ in range(400):
            text = "".join(picks.choice(letters) for _ in range(picks.randint(2, 60)))
            assert ours.encode(text) == library.encode_ordinary(text), text


def test_given_documents_and_edges(spark, both):
    _, library = both
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "x y"), (1000, None), (1001, ""), (1001, "")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    want = sorted(
        (-1 if i is None else i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in rows
        for ids in [library.encode_ordinary(t or "")]
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs).collect())
    assert got == want
    back = decode_ids(encode_texts(docs)).filter("doc_id = 5").first()
    assert bytes(back.data).decode() == dict(rows)[5]
    assert round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0

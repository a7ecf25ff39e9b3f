"""Byte-level BPE encoding and decoding by backtracking over an automaton.

Bytes are mapped to Latin-1 characters, so one Aho-Corasick automaton over all
tokens finds the longest token at every byte of a piece in one pass. The encoder
walks the piece, takes the longest token that may follow the last one, tries
shorter prefixes next and steps back where nothing fits; a place once given up is
never tried again, so the walk is linear. Two tokens may stand side by side when
no merge across their border comes before the merges that made them; the answer
is remembered for each pair. The result is that of applying all merges in the
order of their ranks.

Equal pieces are encoded once per worker within a bounded memo. Encoding and
decoding are row-wise, so the job needs no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from formweave.llm.common import batches, piece_splitter, whole_texts

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MEMO_PIECES = 300_000
_NEVER = 1 << 62


def _merged(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """The parts of some bytes after all merges of a rank under ``below``."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: data for data, rank in self.ranks.items()}
        self.pieces = piece_splitter()
        self._halves: dict[int, tuple[int, int]] = {}  # a token's two parts before its own merge
        self._union: dict[tuple[int, int], int] = {}
        self._side_by_side: dict[tuple[int, int], bool] = {}
        self._memo: dict[str, tuple[int, ...]] = {}
        self._automaton = ahocorasick.Automaton()
        for data, rank in self.ranks.items():
            parts = [data] if len(data) == 1 else _merged(data, self.ranks, rank)
            if len(parts) == 2:
                pair = (self.ranks[parts[0]], self.ranks[parts[1]])
                self._halves[rank], self._union[pair] = pair, rank
            # A token that merges never produce only stands where it is the whole piece.
            if len(parts) <= 2:
                self._automaton.add_word(data.decode("latin-1"), (rank, len(data)))
        self._automaton.make_automaton()
        self._shorter: dict[int, int] = {}
        reached = {data for data, rank in self.ranks.items() if len(data) == 1 or rank in self._halves}
        for data in reached:
            prefix = next((data[:n] for n in range(len(data) - 1, 0, -1) if data[:n] in reached), None)
            if prefix is not None:
                self._shorter[self.ranks[data]] = self.ranks[prefix]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens leaves exactly these two.

        Merges are undone from the latest: at each time one token ends at the
        border and one begins there. If those two have a merge that comes before
        both are absorbed, it would have joined them. Of equal merges the left
        one comes first.
        """
        known = self._side_by_side.get((left, right))
        if known is None:
            known = self._side_by_side[left, right] = self._compatible(left, right)
            if len(self._side_by_side) > 2_000_000:
                self._side_by_side.clear()
        return known

    def _compatible(self, x: int, y: int) -> bool:
        until_x = until_y = _NEVER
        while True:
            merge = self._union.get((x, y), _NEVER)
            if merge < until_x and merge <= until_y and merge != _NEVER:
                return False
            down_x, down_y = self._halves.get(x), self._halves.get(y)
            if down_x and (x > y or not down_y):
                until_x, x = x, down_x[1]
            elif down_y:
                until_y, y = y, down_y[0]
            else:
                return True

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        text = data.decode("latin-1")
        longest = [0] * len(text)
        for end, (token, size) in self._automaton.iter(text):
            longest[end + 1 - size] = token  # ends come in order: the longest comes last
        shorter, sizes = self._shorter, self.bytes_of
        out: list[int] = []
        given_up: set[int] = set()
        at, token = 0, longest[0]
        while at < len(text):
            end = at + len(sizes[token])
            if end not in given_up and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < len(text):
                    token = longest[at]
            else:
                fewer = shorter.get(token)
                while fewer is None:  # step back, and shorten the token before
                    given_up.add(at)
                    token = out.pop()
                    at -= len(sizes[token])
                    fewer = shorter.get(token)
                token = fewer
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, each piece of the pattern for itself."""
        pieces = self.pieces(text)
        memo = self._memo
        if len(memo) > MEMO_PIECES:
            memo.clear()
        for piece in set(pieces).difference(memo):
            memo[piece] = self.encode_bytes(piece.encode("utf-8"))
        return list(chain.from_iterable(map(memo.__getitem__, pieces)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str = VOCABULARY) -> Codec:
    """The codec of a file, built once per worker."""
    return Codec(path)


def encode_texts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every whole text of ``docs`` (doc_id, text).

    A null or empty text has no ids. Repeated rows are encoded each; an empty
    table gives an empty table; other columns are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encoded(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for b in batches(stream):
            ids = pa.array([tool.encode(t) for t in b.column(1).to_pylist()], schema.field(1).type)
            yield pa.record_batch([b.column(0).cast(pa.int64()), ids], schema=schema)

    return whole_texts(docs).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, data): the bytes that the ids of each row stand for."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("data", pa.binary())])

    def decoded(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for b in batches(stream):
            data = pa.array([tool.decode(ids or ()) for ids in b.column(1).to_pylist()], pa.binary())
            yield pa.record_batch([b.column(0), b.column(1).cast(schema.field(1).type), data], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, data binary")


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Encode, decode and digest every text in one pass: doc_id, n_tokens,
    ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digested(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        decimal = {rank: str(rank) for rank in tool.bytes_of}
        for b in batches(stream):
            sizes, ids_sha, data_sha = [], [], []
            for text in b.column(1).to_pylist():
                ids = tool.encode(text)
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                data_sha.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids_sha), pa.array(data_sha)], schema=schema)

    return whole_texts(docs).mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Byte-level BPE encoding in linear time, and decoding.

A text is split by the pattern of the rank file; each piece is encoded on its own.
The piece's bytes, as Latin-1 characters, run once through an Aho-Corasick
automaton of the vocabulary, which gives the longest token from each position.
Tokens are then chosen from left to right, the longest first; a token may follow
its neighbour only if the two are compatible, that is if merging the bytes of both
by rank gives just these two tokens. When nothing fits, the position is ruled out
and the search goes back by one token. Compatibility of two tokens is remembered,
so a piece takes time linear in its length; the result equals the merge loop.

Defined results: null and empty texts have no ids and the hash of the empty
string; special strings are plain text; rows with null or repeated doc_id are
encoded like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shoplens.llm.tables import texts


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token, r in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (len(token), r))
        self.trie.make_automaton()
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int | None] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte. They
        are what its bytes come to by merges of lower rank."""
        if token not in self._halves:
            parts = [self.rank[bytes([c])] for c in self.bytes_of[token]]
            while len(parts) > 2:
                merges = [self.rank.get(self.bytes_of[a] + self.bytes_of[b], token) for a, b in zip(parts, parts[1:])]
                low = min(merges)
                if low >= token:
                    raise ValueError(f"token {token} is not made by merges")
                at = merges.index(low)
                parts[at:at + 2] = [low]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their bytes are merged by rank."""
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            known = self._fits[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Merges are undone from the last to the first. Whenever two tokens meet at the
        # border, their merge must not come before the merge that was undone last; of
        # equal ranks the one further left comes first.
        before = len(self.rank)
        while True:
            joined = self.rank.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            l_parts, r_parts = self.halves(left), self.halves(right)
            if l_parts is None and r_parts is None:
                return True
            if r_parts is None or (l_parts is not None and left > right):
                before, left = left, l_parts[1]
            else:
                before, right = right + 1, r_parts[0]

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self._shorter:
            b = self.bytes_of[token]
            self._shorter[token] = next((self.rank[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.rank), None)
        return self._shorter[token]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n
        reach = [0] * n
        for end, (size, token) in self.trie.iter(piece.decode("latin-1")):
            start = end + 1 - size
            if size > reach[start]:
                reach[start], longest[start] = size, token
        usable = bytearray(b"\1") * (n + 1)
        ids: list[int] = []
        pos, token = 0, longest[0] if n else None
        while pos < n:
            end = pos + len(self.bytes_of[token])
            if usable[end] and (not ids or self.fits(ids[-1], token)):
                ids.append(token)
                pos = end
                token = longest[pos] if pos < n else None
                continue
            token_shorter = self.shorter(token)
            while token_shorter is None:
                usable[pos] = 0
                last = ids.pop()
                pos -= len(self.bytes_of[last])
                token_shorter = self.shorter(last)
            token = token_shorter
        return ids


class PieceMemo(dict):
    """piece (str) -> its ids as little-endian unsigned 32-bit integers. At most
    ``limit`` pieces are held, none longer than ``longest`` characters."""

    def __init__(self, encoder: BytePairEncoder, limit: int = 1_500_000, longest: int = 48):
        super().__init__()
        self.encoder, self.limit, self.longest = encoder, limit, longest

    def __missing__(self, piece: str) -> bytes:
        code = np.array(self.encoder.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = code
        return code


_WORKER: dict = {}


def _worker(path: str, pattern: str):
    if (path, pattern) not in _WORKER:
        encoder = BytePairEncoder(read_ranks(path))
        _WORKER[path, pattern] = (regex.compile(pattern), PieceMemo(encoder), encoder.bytes_of)
    return _WORKER[path, pattern]


def encode_text(text: str, pieces: regex.Pattern, memo: PieceMemo) -> bytes:
    return b"".join(map(memo.__getitem__, pieces.findall(text)))


def decode_ids(ids: bytes, bytes_of: dict[int, bytes]) -> bytes:
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encode_decode(path: str, pattern: str):
    def run(batches):
        pieces, memo, bytes_of = _worker(path, pattern)
        for b in batches:
            ids = [encode_text(t, pieces, memo) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(decode_ids(x, bytes_of)).hexdigest() for x in ids])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return texts(docs).mapInArrow(_encode_decode(ranks_path, pattern),
                                  "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _ids(path: str, pattern: str):
    def run(batches):
        pieces, memo, _ = _worker(path, pattern)
        for b in batches:
            ids = [np.frombuffer(encode_text(t, pieces, memo), "<u4") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))],
                                             names=["doc_id", "ids"])
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<bigint>) of every document."""
    return texts(docs).mapInArrow(_ids(ranks_path, pattern), "doc_id bigint, ids array<bigint>")


def _texts(path: str, pattern: str):
    def run(batches):
        *_, bytes_of = _worker(path, pattern)
        for b in batches:
            out = [b"".join(bytes_of[i] for i in ids) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])
    return run


def decode(ids: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of (doc_id, ids)."""
    return ids.mapInArrow(_texts(ranks_path, pattern), "doc_id bigint, bytes binary")

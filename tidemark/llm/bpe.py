"""Byte-level BPE encoding and decoding by backtracking over longest matches.

Vocabulary tokens are written as Latin-1 text, one character per byte, so that an
Aho-Corasick automaton finds every token occurrence of a piece in one pass. The
encoder takes the longest token at each place; a token may follow another only if
merging their joined bytes gives exactly these two tokens back. An encoding all of
whose neighbours are compatible in this sense is the one that the merges produce.
Where no token fits, the last one is given back and shortened; a place that was
given up is never tried again, so the work is linear in the length of the piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text

#: Entries of the two memos of a worker. They only save time: a full memo is emptied.
PIECE_MEMO = 200_000
PAIR_MEMO = 200_000
#: Pieces of more characters than this are not memoised.
LONG_PIECE = 64
#: Pieces that are encoded at a time, which bounds memory on very long texts.
PIECES_AT_A_TIME = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Encodes single pieces, i.e. matches of the splitting pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.tokens[rank] = token
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.shorter = [self._prefix(token) for token in self.tokens]
        self.pairs: dict[int, bool] = {}

    def _prefix(self, token: bytes) -> int:
        """The longest token that is a proper prefix of ``token``, -1 if there is none."""
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:end])) is not None:
                return rank
        return -1

    def _merged(self, data: bytes) -> list[bytes]:
        """What the merges make of ``data``: lowest rank first, leftmost on ties."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, self.size), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == self.size:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """May ``right`` stand directly after ``left`` in an encoding?"""
        key = left * self.size + right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.tokens[left], self.tokens[right]
            known = self._merged(a + b) == [a, b]
            if len(self.pairs) >= PAIR_MEMO:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        for last, rank in self.matcher.iter(piece.decode("latin-1")):
            longest[last + 1 - len(self.tokens[rank])] = rank  # ends ascend, so the longest is written last
        open_place = bytearray(b"\x01") * (len(piece) + 1)
        chosen: list[int] = []
        place, token = 0, longest[0]
        while place < len(piece):
            while token >= 0:
                end = place + len(self.tokens[token])
                if open_place[end] and (not chosen or self.compatible(chosen[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                chosen.append(token)
                place = end
                token = longest[place] if place < len(piece) else -1
            else:
                if not chosen:
                    raise ValueError("the vocabulary lacks a byte of the text")
                open_place[place] = 0
                token = chosen.pop()
                place -= len(self.tokens[token])
        return chosen


class Pieces(dict):
    """Piece to its ids as little-endian unsigned 32-bit integers; fills itself."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self) >= PIECE_MEMO:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _worker(path: str) -> Pieces:
    return Pieces(Encoder(read_ranks(path)))


def blocks_of_ids(text: str, splitter: regex.Pattern, pieces: Pieces) -> Iterator[bytes]:
    """Packed ids of a whole text, block by block."""
    found = (m[0] for m in splitter.finditer(text)) if len(text) > PIECES_AT_A_TIME else iter(splitter.findall(text))
    while block := list(islice(found, PIECES_AT_A_TIME)):
        yield b"".join(map(pieces.__getitem__, block))


def decode(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every whole text: (doc_id, ids array<int>), one row per input row.

    A null or empty text has no ids. Repeated rows and null ids come out as they
    came in; other columns are not carried. ``rank_file`` is a path that every
    worker can open, as the tokenizer package is installed on all of them.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, splitter = _worker(rank_file), regex.compile(pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [np.frombuffer(b"".join(blocks_of_ids(t or "", splitter, pieces)), "<i4") for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(over, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes that the ids stand for: (doc_id, decoded binary). Null ids give empty bytes."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _worker(rank_file).encoder.tokens
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [b"".join(map(tokens.__getitem__, ids or ())) for ids in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(encoded[id_col].cast("bigint").alias("doc_id"), encoded[ids_col].alias("ids")).mapInArrow(
        over, "doc_id bigint, decoded binary"
    )


def encode_and_verify(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, exact) of every row: as ``encode_documents``, decoded again at once.

    ``exact`` says whether decoding gave the text back.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, splitter = _worker(rank_file), regex.compile(pattern)
        tokens = pieces.encoder.tokens
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids, exact = [], []
                for text in part.column(1).to_pylist():
                    ids.append(np.frombuffer(b"".join(blocks_of_ids(text or "", splitter, pieces)), "<i4"))
                    exact.append(decode(ids[-1], tokens) == (text or "").encode())
                columns = [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()), pa.array(exact)]
                yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "exact"])

    return id_and_text(docs, id_col, text_col).mapInArrow(over, "doc_id bigint, ids array<int>, n_tokens bigint, exact boolean")


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of the ids of every whole text and of what they decode to, in one pass.

    (doc_id, n_tokens, ids_sha256, decoded_sha256, exact), one row per input row;
    ``exact`` says whether decoding gave the text back. A null or empty text has no
    ids. Repeated rows and null ids come out as they came in.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, splitter = _worker(rank_file), regex.compile(pattern)
        tokens = pieces.encoder.tokens
        for batch in batches:
            counts, ids_digests, text_digests, exact = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                for block in blocks_of_ids(text, splitter, pieces):
                    n += len(block) // 4
                    ids_sha.update(block)
                    text_sha.update(decode(np.frombuffer(block, "<u4"), tokens))
                counts.append(n)
                ids_digests.append(ids_sha.hexdigest())
                text_digests.append(text_sha.hexdigest())
                exact.append(text_sha.digest() == hashlib.sha256(text.encode()).digest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests), pa.array(exact)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean"
    return id_and_text(docs, id_col, text_col).mapInArrow(over, schema)

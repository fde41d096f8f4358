"""Removal of repeated word windows by fixed-block anchors.

Every document is cut into reference blocks of seven words side by side, which
are indexed; every rolling window of seven words probes them. Thirteen words in a
row hold at least one whole block wherever they start, so a window that an
earlier document has shows as a hit on one of its blocks. Around the hits, and
only there, the thirteen-word windows themselves meet by their hash: each block
that was hit offers the windows that contain it, each hit asks for its own, and
windows found next to each other make up the maximal exact repeat.

Both meetings are exchanges (see ``exchange``), so a block or a window that a
third of the documents has is one entry per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text, mix, partitions
from tidemark.llm.exchange import (
    ROW,
    STATE,
    answer,
    each_row,
    edges_by_range,
    least_by_key,
    ordered,
    pack,
    pack_sorted,
    rows,
    scan,
    unpack,
    unpack_sorted,
    with_answers,
)
from tidemark.session import cut_lineage

#: Words after which a batch is closed; a longer document is a batch of its own.
BATCH_WORDS = 1_500_000
WORD_MEMO = 300_000
#: Bits of an anchor's hash. Anchors only nominate; windows decide, by 64 bits.
ANCHOR_BITS = 48
NOBODY = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to the eight bytes of its hash, lowest first; fills itself."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = value = xxhash.xxh64_digest(word)[::-1]
        return value


class Words:
    """The words of a batch of documents and what can be said about places in them."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, words: list[list[bytes]], window: int):
        self.ids, self.known, self.words, self.window = ids, known, words, window
        self.block = (window + 1) // 2
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        memo = WordHashes()
        joined = b"".join(b"".join(map(memo.__getitem__, w)) for w in words)
        self.hashes = np.frombuffer(joined, "<u8").astype(np.uint64)
        self.owner = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.hashes)) - self.first[self.owner]
        self.doc = ordered(ids)[self.owner]

    def _of_length(self, length: int) -> np.ndarray:
        """Places where so many words of a document with an id begin."""
        return np.flatnonzero((self.place + length <= self.sizes[self.owner]) & self.known[self.owner])

    def hashed(self, length: int, starts: np.ndarray) -> np.ndarray:
        value = np.full(len(starts), np.uint64(length))
        with np.errstate(over="ignore"):
            for k in range(length):
                value = value * _STEP + self.hashes[starts + k]
        return mix(value)

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every rolling block."""
        starts = self._of_length(self.block)
        return starts, self.hashed(self.block, starts) >> np.uint64(64 - ANCHOR_BITS)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return self.hashed(self.window, starts)

    def around(self, blocks: np.ndarray) -> np.ndarray:
        """Which windows contain one of the marked blocks: a flag for each place, true where such a window starts."""
        marks = np.zeros(len(self.hashes) + 1, np.int64)
        reach = self.window - self.block
        np.add.at(marks, np.maximum(blocks - reach, self.first[self.owner[blocks]]), 1)
        np.add.at(marks, blocks + 1, -1)
        inside = np.cumsum(marks)[:-1] > 0
        allowed = np.zeros(len(inside), bool)
        allowed[self._of_length(self.window)] = True
        return inside & allowed


def _unpacked(state: list[bytes], window: int) -> Words:
    numbers, known = unpack(state[0]).view(np.int64), unpack(state[1]) != 0
    texts = zstandard.decompress(state[2]).split(b"\n")
    return Words(numbers, known, [t.split(b" ") if t else [] for t in texts], window)


def _scan(docs: DataFrame) -> DataFrame:
    """The words of all documents in batches."""

    def closed(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers, known = np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids])
        packed = zstandard.compress(b"\n".join(b" ".join(t) for t in texts), 3)
        return rows([(uuid.uuid4().hex, STATE, [pack(numbers.view(np.uint64)), pack(known), packed])])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, total = [], [], 0
        for batch in batches:
            for number, text in zip(*batch.columns):
                words = (text.as_py() or "").encode().split()
                if texts and total + len(words) > BATCH_WORDS:
                    yield closed(ids, texts)
                    ids, texts, total = [], [], 0
                ids.append(number.as_py())
                texts.append(words)
                total += len(words)
        if ids:
            yield closed(ids, texts)

    return docs.mapInArrow(over, ROW)


def _ask_blocks(words: Words, name: str, buckets: int) -> list[tuple]:
    starts, hashes = words.probes()
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], hashes[order[1:]] != hashes[order[:-1]]])) if len(order) else order
    asked, owner = hashes[order[first]], words.owner[starts[order]]
    # Does more than one document of the batch have it? Documents stand in order, so its places do.
    several = owner[first] != owner[np.append(first[1:], len(order)) - 1] if len(order) else order
    aligned = words.place[starts] % words.block == 0
    offered, offering = least_by_key(hashes[aligned], words.doc[starts[aligned]])
    a, b = edges_by_range(asked, ANCHOR_BITS, buckets), edges_by_range(offered, ANCHOR_BITS, buckets)
    found = []
    for bucket in np.flatnonzero(np.diff(a) > 0).tolist():
        mine, theirs = slice(a[bucket], a[bucket + 1]), slice(b[bucket], b[bucket + 1])
        parts = [pack_sorted(asked[mine]), pack_sorted(offered[theirs]), pack(offering[theirs]), pack(several[mine])]
        found.append((name, bucket, parts))
    return found


def _match_blocks(questions: DataFrame) -> DataFrame:
    """To each batch: for its probes the earliest document that has the block; which of its blocks others probe."""

    def one(bucket: int, batches: list[str], parts: list[list[bytes]]) -> list[tuple]:
        asked, offered = ([unpack_sorted(p[i]) for p in parts] for i in range(2))
        offering = [unpack(p[2]) for p in parts]
        blocks, earliest = least_by_key(np.concatenate(offered), np.concatenate(offering))
        # A block matters if another document probes it: one of another batch, or a second one of the same batch.
        having = np.zeros(len(blocks), np.int64)
        for probes, part in zip(asked, parts):
            at = np.searchsorted(probes, blocks)
            hit = at < len(probes)
            hit[hit] = probes[at[hit]] == blocks[hit]
            having[hit] += 1 + unpack(part[3]).astype(np.int64)[at[hit]]
        matters = having > 1
        blocks, earliest = blocks[matters], earliest[matters]
        found = []
        for batch, probes in zip(batches, asked):
            at = np.searchsorted(blocks, probes)
            hit = at < len(blocks)
            hit[hit] = blocks[at[hit]] == probes[hit]
            found.append((batch, bucket, [pack(hit), pack(earliest[at[hit]])]))
        return found

    return answer(questions, one)


def _hits(words: Words, answers: dict[int, list[bytes]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks that an earlier document has, and of own blocks that documents may share."""
    starts, hashes = words.probes()
    asked, which = np.unique(hashes, return_inverse=True)
    edges = edges_by_range(asked, ANCHOR_BITS, buckets)
    earliest = np.full(len(asked), NOBODY)
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        hit, least = unpack(answers[bucket][0]) != 0, unpack(answers[bucket][1])
        earliest[edges[bucket] : edges[bucket + 1]][hit] = least
    by_place = earliest[which]
    shared = by_place != NOBODY
    aligned = words.place[starts] % words.block == 0
    return starts[shared & (by_place < words.doc[starts])], starts[shared & aligned]


def _ask_windows(words: Words, name: str, answers: dict[int, list[bytes]], buckets: int) -> list[tuple]:
    hits, own = _hits(words, answers, buckets)
    asks, offers = words.around(hits), words.around(own)
    starts = np.flatnonzero(asks | offers)
    keys, least = least_by_key(words.windows(starts), np.where(offers[starts], words.doc[starts], NOBODY))
    edges = edges_by_range(keys, 64, buckets)
    return [
        (name, bucket, [pack_sorted(keys[edges[bucket] : edges[bucket + 1]]), pack(~least[edges[bucket] : edges[bucket + 1]])])
        for bucket in np.flatnonzero(np.diff(edges)).tolist()
    ]


def _match_windows(questions: DataFrame, buckets: int) -> DataFrame:
    """To each batch the earliest document that has each window it named."""

    def one(bucket: int, batches: list[str], parts: list[list[bytes]]) -> list[tuple]:
        keys, least = [unpack_sorted(p[0]) for p in parts], [~unpack(p[1]) for p in parts]
        distinct, earliest = least_by_key(np.concatenate(keys), np.concatenate(least))
        return [
            (batch, buckets + bucket, [pack(~earliest[np.searchsorted(distinct, own)])]) for batch, own in zip(batches, keys)
        ]

    return answer(questions, one)


def _removed(words: Words, answers: dict[int, list[bytes]], buckets: int) -> np.ndarray:
    """A flag for each word of the batch."""
    hits, own = _hits(words, answers, buckets)
    asks, offers = words.around(hits), words.around(own)
    starts = np.flatnonzero(asks | offers)
    distinct, which = np.unique(words.windows(starts), return_inverse=True)
    edges = edges_by_range(distinct, 64, buckets)
    earliest = np.full(len(distinct), NOBODY)
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        earliest[edges[bucket] : edges[bucket + 1]] = ~unpack(answers[buckets + bucket][0])
    repeated = starts[earliest[which] < words.doc[starts]]
    marks = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(marks, repeated, 1)
    np.add.at(marks, repeated + words.window, -1)
    return np.cumsum(marks)[:-1] > 0


def drop_repeats(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept) of every row: the text without words that earlier documents cover.

    A word goes if it lies in ``window`` words in a row that also begin in a
    document with a smaller doc_id. Windows are judged on the input. ``kept`` has
    the other words joined by blanks. Null and empty texts have no words. A row
    without an id comes neither before nor after any other: it is kept whole and
    takes nothing away. Rows with the same id do not remove each other's words.
    """
    spark = docs.sparkSession
    buckets = buckets or partitions(spark)
    scanned = scan(_scan(id_and_text(docs, id_col, text_col)), partitions(spark))

    def ask_blocks(name: str, state: list[bytes], answers: dict[int, list[bytes]]) -> Iterator[list[tuple]]:
        yield _ask_blocks(_unpacked(state, window), name, buckets)

    blocks = cut_lineage(_match_blocks(each_row(with_answers(scanned.states), ask_blocks, ROW, rows)))

    def ask(name: str, state: list[bytes], answers: dict[int, list[bytes]]) -> Iterator[list[tuple]]:
        yield _ask_windows(_unpacked(state, window), name, answers, buckets)

    windows = cut_lineage(_match_windows(each_row(with_answers(scanned.states, blocks), ask, ROW, rows), buckets))

    def cut(name: str, state: list[bytes], answers: dict[int, list[bytes]]) -> Iterator[tuple]:
        words = _unpacked(state, window)
        gone = _removed(words, answers, buckets)
        yield words, gone

    def made(found: tuple) -> pa.RecordBatch:
        words, gone = found
        kept, removed, spans = [], [], []
        for own, start, size in zip(words.words, words.first.tolist(), words.sizes.tolist()):
            flags = gone[start : start + size]
            removed.append(int(flags.sum()))
            spans.append(int((flags[1:] & ~flags[:-1]).sum()) + int(flags[:1].sum()))
            kept.append(b" ".join(own[i] for i in np.flatnonzero(~flags)) if removed[-1] else b" ".join(own))
        columns = [
            pa.array(words.ids, pa.int64(), mask=~words.known),
            pa.array(words.sizes),
            pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()),
            pa.array(kept, pa.binary()),
        ]
        return pa.record_batch(columns, ["doc_id", "n_words", "n_removed", "n_spans", "kept"])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept binary"
    return each_row(with_answers(scanned.states, blocks, windows), cut, schema, made)

"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is an Arrow batch of documents or a part of one. Its words become symbols of the phrases'
vocabulary; other words can be part of no phrase, so they only separate, and runs
of known words that are shorter than the shortest phrase are left out as well.
Over the runs that remain stand a suffix order, its Burrows-Wheeler transform in a
wavelet matrix with bit ranks, and suffix positions sampled at every eighth place
and at every start of a run. All phrases are searched backwards at once, a symbol
per step; the rows found walk back to a sampled place, which tells document and
word. Hits of a document are merged to disjoint spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text
from tidemark.session import cut_lineage

#: Word characters: digits, letters and every byte of a character beyond ASCII; A-Z is lowered, the rest parts words.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Bytes of test texts that are searched in one pass over the documents; it bounds what a pass holds and broadcasts.
BLOCK_BYTES = 16_000_000
#: Distance of the sampled suffix positions.
SAMPLED = 8
#: Documents that make up a shard at most, and words after which a shard is closed.
SHARD_WORDS = 4_000_000

SPANS = "array<struct<first:int,past:int>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class BitRanks:
    """A bit vector that counts the ones before any place, 64 bits to a word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Symbols by bit levels, the highest bit first; every level sorts stably by its bit."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        rest = symbols
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (rest >> shift) & 1 == 1
            self.levels.append((shift, BitRanks(bits), int(len(bits) - bits.sum())))
            rest = np.concatenate([rest[~bits], rest[bits]])
        self.first = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, ranks, zeros in self.levels:
            ones = ranks.ones(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._down(symbol, at) - self.first[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), np.int64)
        for shift, ranks, zeros in self.levels:
            bit, ones = ranks.get(at), ranks.ones(at)
            symbol |= bit.astype(np.int64) << shift
            at = np.where(bit, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Over runs of symbols from 1 up, each run closed by one 0."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        order = self._order(symbols)
        self.size = len(symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])[:sigma]
        self.transform = WaveletMatrix(symbols[order - 1], sigma)
        starts = symbols[np.arange(self.size) - 1] == 0
        sampled = starts[order] | (order % SAMPLED == 0)
        self.marks = BitRanks(sampled)
        self.places = order[sampled]

    @staticmethod
    def _order(symbols: np.ndarray) -> np.ndarray:
        """Suffix order by doubling; the closing zeros rank by place, so no comparison leaves its run."""
        size = len(symbols)
        closing = symbols == 0
        n_closing = int(closing.sum())
        rank = symbols + n_closing
        rank[closing] = np.arange(n_closing)
        step = 1
        while True:
            after = np.full(size, -1, np.int64)
            after[:-step] = rank[step:]
            key = rank * np.int64(size + n_closing + int(symbols.max(initial=0)) + 2) + after + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(size, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if new[order[-1]] == size - 1 or step >= size // 2 + 1:
                return order
            rank, step = new, 2 * step

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; ``phrases`` holds symbols right-aligned."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((back <= lengths) & (low < high))
            symbol = phrases[live, -back]
            low[live] = self.below[symbol] + self.transform.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.transform.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes by row."""
        places, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        walking, at = np.arange(len(rows)), rows.copy()
        while len(walking):
            done = self.marks.get(at)
            places[walking[done]] = self.places[self.marks.ones(at[done])] + steps[walking[done]]
            walking, at = walking[~done], at[~done]
            steps[walking] += 1
            symbol, rank = self.transform.symbol_and_rank(at)
            at = self.below[symbol] + rank
        return places


@dataclass(frozen=True)
class Phrases:
    """A block of test phrases over its own vocabulary; symbol 0 is every other word."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    owners: list[list[str]]


def phrases_of(items: list[tuple[str | None, str | None]], window: int) -> Phrases | None:
    """The distinct windows of (item id, text) pairs with the items that each stands in."""
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for name, text in items:
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of((text or "").encode())]
        for start in range(max(1, len(words) - window + 1) if words else 0):
            owners = found.setdefault(tuple(words[start : start + window]), set())
            if name is not None:
                owners.add(name)
    if not found:
        return None
    lengths = np.array([len(p) for p in found])
    symbols = np.zeros((len(found), window), np.int64)
    for i, phrase in enumerate(found):
        symbols[i, window - len(phrase) :] = phrase
    return Phrases(vocabulary, symbols, lengths, [sorted(x) for x in found.values()])


def hits_of(symbols: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(place, phrase) of every occurrence of a phrase in ``symbols``, where zeros separate."""
    none = np.empty(0, np.int64)
    padded = np.concatenate([[0], symbols, [0]])
    edges = np.flatnonzero((padded[1:] != 0) != (padded[:-1] != 0))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= phrases.lengths.min()
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return none, none
    # Each run with the zero that closes it, side by side; ``shift`` leads back.
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    shift = np.repeat(starts - offsets[:-1], sizes + 1)
    runs = np.arange(offsets[-1])
    packed = padded[1:][runs + shift]
    index = FMIndex(packed, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.symbols, phrases.lengths)
    counts = high - low
    which = np.repeat(np.arange(len(low)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
    places = index.locate(rows)
    return places + shift[places], which


def shards(batch: pa.RecordBatch, at: int, block: Phrases) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the symbols of their texts, a zero after each text, and the words of each text."""
    known, start = block.vocabulary, 0
    while start < batch.num_rows:
        parts, sizes, total = [], [], 0
        while start + len(sizes) < batch.num_rows and total < SHARD_WORDS:
            words = words_of((batch.column(at)[start + len(sizes)].as_py() or "").encode())
            parts.append(np.array([known.get(w, 0) for w in words] + [0], np.int64))
            sizes.append(len(words))
            total += len(words) + 1
        yield batch.slice(start, len(sizes)), np.concatenate(parts), np.array(sizes, np.int64)
        start += len(sizes)


def mark_spans(marked: DataFrame, phrases: Phrases, keep_text: bool) -> DataFrame:
    """Add to ``spans`` and ``items`` of (doc_id, text, spans, items) what a block of phrases hits."""
    shipped = marked.sparkSession.sparkContext.broadcast(phrases)
    fields = "doc_id bigint, n_words bigint, " + f"spans {SPANS}, items array<string>" + (", text string" if keep_text else "")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped.value
        for batch in batches:
            for part, symbols, sizes in shards(batch, 1, block):
                yield shard(part, symbols, sizes, block)

    def shard(batch: pa.RecordBatch, symbols: np.ndarray, sizes: np.ndarray, block: Phrases) -> pa.RecordBatch:
        places, which = hits_of(symbols, block)
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        turns = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(turns, places, 1)
        np.add.at(turns, places + block.lengths[which], -1)
        before = batch.column(2).to_pylist()
        for i, spans in enumerate(before):
            for span in spans or ():
                turns[first[i] + span["first"]] += 1
                turns[first[i] + span["past"]] -= 1
        inside = np.concatenate([[False], np.cumsum(turns) > 0])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        opened, closed = edges[::2], edges[1::2]
        owner = np.searchsorted(first, opened, side="right") - 1
        spans = [[] for _ in sizes]
        for doc, a, b in zip(owner.tolist(), opened.tolist(), closed.tolist()):
            spans[doc].append({"first": a - int(first[doc]), "past": b - int(first[doc])})
        items = [set(x or ()) for x in batch.column(3).to_pylist()]
        pairs = np.unique(np.column_stack([np.searchsorted(first, places, side="right") - 1, which]), axis=0)
        for doc, phrase in pairs.tolist():
            items[doc].update(block.owners[phrase])
        made = [batch.column(0), pa.array(sizes), pa.array(spans, _SPANS), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
        names = ["doc_id", "n_words", "spans", "items"]
        if keep_text:
            made, names = [*made, batch.column(1)], [*names, "text"]
        return pa.record_batch(made, names)

    return marked.select("doc_id", "text", "spans", "items").mapInArrow(over, fields)


def item_blocks(items: DataFrame, item_col: str, text_col: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The test items in blocks of about ``limit`` bytes, one at a time on the driver.

    Repeated items, which count once, are dropped first: their copies would share a block.
    """
    named = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    named = cut_lineage(named.distinct())
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 2 * size // limit + 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for block in range(blocks):
        yield [tuple(row) for row in named.filter(part == block).collect()]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``.

    ``spans`` are the disjoint word ranges covered by occurrences of the items'
    windows of ``window`` words (a shorter item is one window); ``items`` names
    the items hit, in order. Null texts have no words. An item without an id marks
    words but is not named; repeated items count once. Large item tables are
    searched in blocks, each in one pass over the documents without a shuffle.
    """
    marked = id_and_text(docs, id_col, text_col).withColumns(
        {"spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")}
    )
    searches = (p for block in item_blocks(items, item_col, item_text_col) if (p := phrases_of(block, window)))
    waiting = next(searches, None)
    if waiting is None:
        blank = Phrases({}, np.zeros((1, 1), np.int64), np.array([1]), [[]])
        return mark_spans(marked, blank, keep_text=False)
    for following in searches:
        marked, waiting = mark_spans(marked, waiting, keep_text=True), following
    return mark_spans(marked, waiting, keep_text=False)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs``, all columns, without the rows of which a window of an item covers a word."""
    at = docs.columns.index(text_col)
    clean = docs
    for block in item_blocks(items, item_col, item_text_col):
        if phrases := phrases_of(block, window):
            clean = clean.mapInArrow(_without_hits(clean.sparkSession.sparkContext.broadcast(phrases), at), docs.schema)
    return clean


def _without_hits(shipped, at: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped.value
        for batch in batches:
            for part, symbols, sizes in shards(batch, at, block):
                first = np.concatenate([[0], np.cumsum(sizes + 1)])
                clean = np.ones(len(sizes), bool)
                clean[np.searchsorted(first, hits_of(symbols, block)[0], side="right") - 1] = False
                yield part.filter(pa.array(clean))

    return over

"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

What follows a text can change its last tokens only. How far back a change can reach
follows from the merge list: a boundary between two equal segmentations moves left
over a token ``u`` only when a rule (u, v) merges in one of them and not in the other,
and the next rule that moves it again needs a right part that begins with that ``u``.
The heaviest chain of such rules, in bytes, is a lookahead that always suffices
(``sufficient_lookahead``; 320 bytes for a common list of 50,000 merges). A token is
emitted once that many bytes behind it are known, so the transducer holds a window of
fixed size whatever the length of the text.

In front of it, a splitter cuts the text where the tokenizer file says: at added tokens
and at the classes of the byte-level pattern. It, too, holds back only what more text
could still change. The decoder turns ids into bytes and those into text with a state
machine that keeps an unfinished character until its other bytes come.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

#: Pieces in each of a worker's two memos; a full one becomes the old one. They only save time.
PIECE_MEMO = 150_000
#: Pieces of more characters than this are not remembered but streamed.
LONG_PIECE = 64
#: Bytes that are merged at a time beyond the lookahead; more than any token has.
BLOCK = 2048
#: Characters of a text that are split at a time.
CHUNK = 1 << 16

# The splitting pattern of the byte-level form, and its four kinds of run.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RUNS = [r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+"]
# Letters and numbers that Unicode has added after version 16. The tokenizer's
# tables are of that version, where they are unassigned; those of ``regex`` know them already.
NEW_LETTERS = "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
NEW_NUMBERS = "\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"


def without_new(pattern: str) -> str:
    """``pattern`` with letters and numbers as of Unicode 16."""
    outside = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\p{L}\p{N}]|[" + NEW_LETTERS + NEW_NUMBERS + "])")
    inside = outside.replace(r"\p{L}+", rf"(?:(?![{NEW_LETTERS}])\p{{L}})+")
    return inside.replace(r"\p{N}+", rf"(?:(?![{NEW_NUMBERS}])\p{{N}})+")


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte: itself where it is visible, else the next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Bytes behind a token's end that settle it, whatever follows them.

    ``merges`` are in order of rank; each makes a token of its own out of parts that are
    bytes or made by earlier rules, which is checked. ``reach[u]`` is the heaviest chain so
    far that ends in a rule with left part ``u``; a rule (u, v) continues the chains of all
    tokens at the left edge of ``v``.
    """
    left: dict[str, str] = {}
    reach: dict[str, int] = {}
    furthest = 0
    for u, v in merges:
        for part in (u, v):
            if len(part) > 1 and part not in left:
                raise ValueError(f"{part!r} is merged before it is made")
        if u + v in left:
            raise ValueError(f"two rules make {u + v!r}")
        before, edge = 0, v
        while edge is not None:
            before = max(before, reach.get(edge, 0))
            edge = left.get(edge)
        reach[u] = max(reach.get(u, 0), before + len(u))
        furthest = max(furthest, reach[u])
        left[u + v] = u
    return furthest


class Vocabulary:
    """Merges, added tokens and token bytes of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self._check(given)
        letters = byte_letters()
        model = given["model"]
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rules = {(ids[u], ids[v]): (rank, ids[u + v]) for rank, (u, v) in enumerate(pairs)}
        self.none = (len(pairs), -1)
        self.lookahead = sufficient_lookahead(pairs)
        self.of_byte = [-1] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {}
        for token, i in (ids | self.added).items():
            spelled = all(c in letters for c in token)
            self.bytes_of[i] = bytes(letters[c] for c in token) if spelled else token.encode()
        if max(map(len, self.bytes_of.values())) >= BLOCK:
            raise ValueError("a token is longer than a block")

    @staticmethod
    def _check(given: dict) -> None:
        """Only the plain byte-level form is known; anything else is an error, never a silent difference."""
        model, split = given["model"], given["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and given["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(t[k] for t in given["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE file")

    def merge(self, data: bytes) -> list[int]:
        """Ids of ``data`` by itself: the rule of lowest rank first, leftmost on ties."""
        return self._by_scan(data) if len(data) <= LONG_PIECE else self._by_heap(data)

    def _by_scan(self, data: bytes) -> list[int]:
        """For short data: the lowest rank is looked up anew after each merge."""
        ids = [self.of_byte[b] for b in data]
        get, none = self.rules.get, self.none
        steps = [get(pair, none) for pair in zip(ids, ids[1:])]
        while steps:
            step = min(steps)
            if step is none:
                break
            k = steps.index(step)
            ids[k : k + 2] = [step[1]]
            del steps[k]
            if k < len(steps):
                steps[k] = get((ids[k], ids[k + 1]), none)
            if k:
                steps[k - 1] = get((ids[k - 1], ids[k]), none)
        return ids

    def _by_heap(self, data: bytes) -> list[int]:
        n = len(data)
        ids = [self.of_byte[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rules = self.rules
        heap = [(rules[pair][0], k, pair) for k in range(n - 1) if (pair := (ids[k], ids[k + 1])) in rules]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            right = after[k]
            if right >= n or (ids[k], ids[right]) != pair:
                continue  # one of the two has been merged since
            ids[k], ids[right], after[k] = rules[pair][1], -1, after[right]
            if after[k] < n:
                before[after[k]] = k
                new = (ids[k], ids[after[k]])
                if new in rules:
                    heapq.heappush(heap, (rules[new][0], k, new))
            if before[k] >= 0:
                new = (ids[before[k]], ids[k])
                if new in rules:
                    heapq.heappush(heap, (rules[new][0], before[k], new))
        return [i for i in ids if i >= 0]


class ByteTransducer:
    """Bytes of one piece in, ids out as soon as nothing that follows can change them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.window = vocabulary, b""

    def feed(self, data: bytes) -> list[int]:
        found: list[int] = []
        whole = self.vocabulary.lookahead + BLOCK
        for start in range(0, len(data), BLOCK):
            self.window += data[start : start + BLOCK]
            if len(self.window) < whole:
                continue
            stable, end = len(self.window) - self.vocabulary.lookahead, 0
            for i in self.vocabulary.merge(self.window):
                size = len(self.vocabulary.bytes_of[i])
                if end + size > stable:
                    break
                end += size
                found.append(i)
            self.window = self.window[end:]
        return found

    def finish(self) -> list[int]:
        rest, self.window = self.window, b""
        return self.vocabulary.merge(rest)


class Pieces(dict):
    """Piece to its ids; fills itself, and keeps those in use when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(piece) > LONG_PIECE:
            transducer = ByteTransducer(self.vocabulary)
            return (*transducer.feed(piece.encode()), *transducer.finish())
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(self.vocabulary.merge(piece.encode()))  # the piece ends before the window is full
        if len(self) >= PIECE_MEMO:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Text in parts of any size in, ids out; the parts' borders make no difference.

    ``rest`` holds characters whose piece may still grow. A run of one class that does not
    end within a chunk is an open piece: its bytes go to a transducer as they come.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.vocabulary = pieces.vocabulary
        self.rest = ""
        self.open: tuple[regex.Pattern, ByteTransducer] | None = None

    def feed(self, text: str) -> Iterator[list[int]]:
        for start in range(0, len(text), CHUNK):
            self.rest += text[start : start + CHUNK]
            if len(self.rest) >= CHUNK:
                yield from self._run(final=False)

    def finish(self) -> Iterator[list[int]]:
        yield from self._run(final=True)

    def _run(self, final: bool) -> Iterator[list[int]]:
        """Ids of what ``rest`` settles."""
        text = self.rest
        place = 0
        if self.vocabulary.added:
            for found in _added(tuple(self.vocabulary.added)).finditer(text):
                yield from self._segment(text[place : found.start()], True)
                yield [self.vocabulary.added[found[0]]]
                place = found.end()
        text = text[place:]
        end = len(text) if final else _whole(text, tuple(self.vocabulary.added))
        used = 0
        for ids, used in self._pieces(text[:end], final):
            yield ids
        self.rest = text[used:]

    def _segment(self, text: str, final: bool) -> Iterator[list[int]]:
        for ids, _ in self._pieces(text, final):
            yield ids

    def _pieces(self, text: str, final: bool) -> Iterator[tuple[list[int], int]]:
        """(ids, characters used so far) of pieces that are settled; all of them if the text ends here."""
        place = 0
        if self.open:
            pattern, transducer = self.open
            run = pattern.match(text)
            place = run.end() if run else 0
            ended = final or place < len(text)
            if pattern is _BLANKS and place and (place < len(text) or not final):
                place -= 1  # the last blank of a run goes with what follows, unless the text ends
            ids = transducer.feed(text[:place].encode())
            if ended:
                ids += transducer.finish()
                self.open = None
            yield ids, place
            if not ended:
                return
        if final:
            if place < len(text):
                split = _splitter(text).findall(text, place)
                yield list(chain.from_iterable(map(self.pieces.__getitem__, split))), len(text)
            return
        settled: list[int] = []
        for found in _splitter(text).finditer(text, place):
            if found.end() >= len(text) or found.start() + 3 > len(text):
                break
            settled += self.pieces[found[0]]
            place = found.end()
        if settled:
            yield settled, place
        if len(text) - place > CHUNK // 2:  # one piece fills the buffer: go on inside it
            lead = place + (text[place] == " " and not _BLANKS.match(text, place + 1))
            pattern = next(p for p in _RUNS if p.match(text, lead))
            transducer = ByteTransducer(self.vocabulary)
            end = len(text) - (pattern is _BLANKS)
            self.open = (pattern, transducer)
            yield transducer.feed(text[place:end].encode()), end


class Decoder:
    """Ids in parts of any size in, text out; a character that is not whole yet waits for its other bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """Ids that the vocabulary does not have stand for nothing."""
        known = self.vocabulary.bytes_of
        try:
            return self.state.decode(b"".join(map(known.__getitem__, ids)))
        except KeyError:
            return self.state.decode(b"".join(known.get(i, b"") for i in ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


_NEW = re.compile(f"[{NEW_LETTERS}{NEW_NUMBERS}]")
_SPLIT = regex.compile(PATTERN), regex.compile(without_new(PATTERN))
_RUNS = [regex.compile(without_new(r)) for r in RUNS]
_BLANKS = _RUNS[-1]


def _splitter(text: str) -> regex.Pattern:
    return _SPLIT[not text.isascii() and _NEW.search(text) is not None]


@lru_cache(maxsize=8)
def _added(tokens: tuple[str, ...]) -> re.Pattern:
    """Added tokens, the longest where several begin."""
    return re.compile("|".join(map(re.escape, sorted(tokens, key=len, reverse=True))))


def _whole(text: str, tokens: tuple[str, ...]) -> int:
    """Where the first added token may begin that the text cuts off."""
    longest = max(map(len, tokens), default=0)
    for place in range(max(0, len(text) - longest + 1), len(text)):
        if any(t.startswith(text[place:]) for t in tokens):
            return place
    return len(text)


def _batches(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows in batches that are closed early when they are long."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if len(held) >= 1000 or size >= 1 << 20:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


@lru_cache(maxsize=2)
def _worker(path: str) -> Pieces:
    return Pieces(Vocabulary(path))


def encode_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, one row per input row.

    A null or empty text has no ids; repeated rows and null ids come out as they came in; an
    empty table gives no rows; other columns are not carried. Added tokens in a text become
    their ids. ``tokenizer_file`` is a path that every worker can open, as the tokenizer
    package is installed on all of them.
    """

    def rows(batch: pa.RecordBatch, pieces: Pieces) -> Iterator[tuple[int, list[int]]]:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            encoder = Encoder(pieces)
            yield key, list(chain.from_iterable(chain(encoder.feed(text.as_py()), encoder.finish())))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _worker(tokenizer_file)
        for batch in batches:
            yield from _batches(rows(batch, pieces), [pa.int64(), pa.list_(pa.int32())], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(over, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) that the ids stand for, one row per input row.

    Null or empty ids give an empty text; ids outside the vocabulary and null ids within a row
    stand for nothing; bytes that are no UTF-8 become U+FFFD, one for each maximal broken part.
    """

    def rows(batch: pa.RecordBatch, vocabulary: Vocabulary) -> Iterator[tuple[int, str]]:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            decoder = Decoder(vocabulary)
            yield key, decoder.feed(ids.as_py() or []) + decoder.finish()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _worker(tokenizer_file).vocabulary
        for batch in batches:
            yield from _batches(rows(batch, vocabulary), [pa.int64(), pa.string()], ["doc_id", "text"])

    chosen = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(over, "doc_id bigint, text string")


def round_trip(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, exact) of every whole text in one streaming pass.

    The digests are of the decimal ids joined by commas and of the decoded text in UTF-8;
    ``exact`` says whether that is the text. Rows as in ``encode_documents``; neither the
    ids nor the decoded text of a document are ever held as a whole.
    """

    def one(text: str, pieces: Pieces, decimal: dict[int, bytes]) -> tuple[int, str, str, bool]:
        encoder, decoder = Encoder(pieces), Decoder(pieces.vocabulary)
        ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
        for ids in chain(encoder.feed(text), encoder.finish()):
            if ids:
                ids_sha.update((b"," if n else b"") + b",".join(map(decimal.__getitem__, ids)))
                text_sha.update(decoder.feed(ids).encode())
                n += len(ids)
        text_sha.update(decoder.finish().encode())
        return n, ids_sha.hexdigest(), text_sha.hexdigest(), text_sha.digest() == hashlib.sha256(text.encode()).digest()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _worker(tokenizer_file)
        decimal = {i: b"%d" % i for i in pieces.vocabulary.bytes_of}
        for batch in batches:
            found = [one(value.as_py(), pieces, decimal) for value in batch.column(1)]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.string(), pa.bool_()))] if found else []
            if found:
                yield pa.record_batch([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean"
    return id_and_text(docs, id_col, text_col).mapInArrow(over, schema)

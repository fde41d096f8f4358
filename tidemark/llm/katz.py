"""Katz backoff scores of whole texts from a bigram model of the corpus.

Words and bigrams are counted over all training documents. Counts up to five are
discounted by Good-Turing; what a history loses, and one count that each history
sets aside, goes to the words not seen after it in proportion to their unigram
probabilities, so every distribution sums to one. Unigrams are treated the same
way with a single unknown word at the end of the chain.

Counting and looking up are two exchanges (see ``exchange``): one over words, one
over bigrams. The counts of a bucket are a partition of the stored tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, partitions
from tidemark.llm.exchange import ROW, STATE, answer, each_row, edges_by_range, pack, rows, scan, unpack, with_answers
from tidemark.session import cut_lineage

#: Counts up to this one are discounted.
MOST_DISCOUNTED = 5
#: Tokens after which a batch is closed; a longer document is a batch of its own.
BATCH_TOKENS = 1_500_000
WORD_MEMO = 300_000
#: Neither can be a word, as words hold no line feeds.
END, START = (xxhash.xxh64_intdigest(mark) for mark in (b"\n", b"\n\n"))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


@dataclass(frozen=True)
class Totals:
    """Numbers of the whole corpus that every task needs; a fixed few."""

    tokens: int
    words: int
    unigram: np.ndarray
    bigram: np.ndarray
    buckets: int
    few_words: np.ndarray

    @property
    def unknown(self) -> float:
        """Unigram probability of the unknown word."""
        r = np.arange(1, MOST_DISCOUNTED + 1)
        return (1.0 + float((r * self.few_words * (1 - self.unigram[1:])).sum())) / (self.tokens + 1)

    def p_word(self, counts: np.ndarray) -> np.ndarray:
        kept = counts * self.unigram[np.where(counts <= MOST_DISCOUNTED, counts, 0)]
        return np.where(counts > 0, kept / (self.tokens + 1), self.unknown)

    def salts(self, history: np.ndarray) -> np.ndarray:
        """Into how many shares the bigrams of a history of so many tokens are dealt."""
        return np.maximum(1, -(-4 * history * self.buckets // max(1, self.tokens)))


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Good-Turing factors by count, 1 at place 0 for all counts that stay as they are.

    ``counts_of_counts`` starts with the number of items seen once. A factor that
    the formula leaves outside (0, 1), as on small corpora, takes half a count off.
    """
    n = np.concatenate([[0.0], counts_of_counts.astype(float)])
    k = MOST_DISCOUNTED
    factors = np.ones(k + 1)
    tail = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        good = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (good - tail) / (1 - tail) if tail < 1 else 0.0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return factors


def _scan(docs: DataFrame, buckets: int) -> DataFrame:
    """States and word questions of all batches of (doc_id, text, held_out)."""

    def closed(ids: list, held: list[bool], sizes: list[int], hashes: list[int]) -> pa.RecordBatch:
        name = uuid.uuid4().hex
        keys, tokens = np.unique(np.array([START, *hashes], np.uint64), return_inverse=True)
        tokens, lengths = tokens[1:], np.array(sizes)
        train = np.repeat(~np.array(held, bool), lengths)
        counts = np.bincount(tokens[train], minlength=len(keys))
        known = np.array([i is not None for i in ids])
        numbers = np.array([i or 0 for i in ids], np.int64).view(np.uint64)
        marks = np.searchsorted(keys, np.array([START], np.uint64))
        state = [pack(x) for x in (numbers, known, np.array(held), lengths, tokens, marks)]
        found: list[tuple[str | None, int, list[bytes]]] = [(name, STATE, state)]
        edges = edges_by_range(keys, 64, buckets)
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            found.append((name, bucket, [pack(keys[part]), pack(counts[part])]))
        return rows(found)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        ids, held, sizes, hashes = [], [], [], []
        for batch in batches:
            for number, text, out in zip(*batch.columns):
                words = (text.as_py() or "").encode().lower().split()
                if hashes and len(hashes) + len(words) > BATCH_TOKENS:
                    yield closed(ids, held, sizes, hashes)
                    ids, held, sizes, hashes = [], [], [], []
                hashes += map(memo.__getitem__, words)
                hashes.append(END)
                ids.append(number.as_py())
                held.append(out.as_py())
                sizes.append(len(words) + 1)
        if ids:
            yield closed(ids, held, sizes, hashes)

    return docs.mapInArrow(over, ROW)


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(counts[counts <= MOST_DISCOUNTED + 1], minlength=MOST_DISCOUNTED + 2)[1:]


def _count_words(questions: DataFrame) -> DataFrame:
    """To each batch the place of its words in the bucket and their training counts; totals under no batch."""

    def one(bucket: int, batches: list[str], parts: list[list[bytes]]) -> list[tuple]:
        keys, counts = ([unpack(p[i]) for p in parts] for i in range(2))
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, np.concatenate(counts).astype(np.int64))
        found: list[tuple] = []
        at = 0
        for batch, own in zip(batches, keys):
            mine = place[at : at + len(own)]
            found.append((batch, bucket, [pack(mine), pack(total[mine])]))
            at += len(own)
        sums = np.concatenate([[total.sum(), (total > 0).sum()], _counts_of_counts(total)])
        return [*found, (None, bucket, [pack(sums)])]

    return answer(questions, one)


def _summed(answers: DataFrame, part: int) -> np.ndarray:
    """Sum over the buckets of a packed vector of fixed length; one short row per bucket reaches the driver."""
    got = answers.filter(F.col("batch").isNull()).select(F.col("parts")[part]).collect()
    return sum((unpack(r[0]).astype(np.int64) for r in got), np.zeros(MOST_DISCOUNTED + 3, np.int64))


@dataclass
class Batch:
    """A batch of documents with what the word tables say about it."""

    ids: np.ndarray
    known: np.ndarray
    held: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    history: np.ndarray
    as_history: np.ndarray

    @classmethod
    def of(cls, state: list[bytes], answers: dict[int, list[bytes]], totals: Totals) -> Batch:
        numbers, known, held, sizes, tokens, marks = map(unpack, state)
        order = sorted(k for k in answers if k < totals.buckets)
        places = [unpack(answers[k][0]) * np.uint64(totals.buckets) + np.uint64(k) for k in order]
        counts = np.concatenate([unpack(answers[k][1]) for k in order]).astype(np.int64)
        tokens, sizes = tokens.astype(np.int64), sizes.astype(np.int64)
        ends = tokens[np.cumsum(sizes) - 1]
        history = np.full(len(tokens), int(marks[0]))
        history[1:] = tokens[:-1]
        history[np.cumsum(sizes)[:-1]] = int(marks[0])
        # A document starts as often as one ends; START itself is no token and has no count.
        as_history = counts.copy()
        as_history[int(marks[0])] = counts[ends[0]]
        ids, words = numbers.view(np.int64), np.concatenate(places)
        return cls(ids, known != 0, held != 0, sizes, tokens, words, counts, history, as_history)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams as (history, word) by place in the batch's words, and the bigram of each token."""
        size = len(self.words)
        distinct, which = np.unique(self.history * size + self.tokens, return_inverse=True)
        return distinct // size, distinct % size, which

    def dealt(self, first: np.ndarray, second: np.ndarray, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Order of the bigrams by bucket, and the bucket edges in it."""
        salts = totals.salts(self.as_history[first])
        salt = mix(self.words[second], 1) % salts.astype(np.uint64)
        bucket = (mix(mix(self.words[first]) + salt, 2) % np.uint64(totals.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(totals.buckets + 1))


def _ask_bigrams(batch: Batch, name: str, totals: Totals) -> list[tuple]:
    first, second, which = batch.pairs()
    train = np.bincount(which[np.repeat(~batch.held, batch.sizes)], minlength=len(first))
    order, edges = batch.dealt(first, second, totals)
    found = []
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        part = order[edges[bucket] : edges[bucket + 1]]
        heads, runs = np.unique(first[part], return_counts=True)  # pairs are in order of their history
        values = (
            batch.words[heads],
            runs,
            batch.as_history[heads] * 4 * totals.buckets > totals.tokens,
            batch.words[second[part]],
            train[part],
            batch.counts[second[part]],
        )
        found.append((name, bucket, [pack(x) for x in values]))
    return found


def _count_bigrams(questions: DataFrame, totals: Totals) -> DataFrame:
    """To each batch the counts of its bigrams, and sums over a history where one of its bigrams is unseen.

    Histories that are dealt over several buckets give their sums under no batch.
    """

    def one(bucket: int, batches: list[str], parts: list[list[bytes]]) -> list[tuple]:
        asked = [[unpack(x) for x in p] for p in parts]
        heads = np.concatenate([a[0] for a in asked])
        runs = np.concatenate([a[1] for a in asked]).astype(np.int64)
        split = np.concatenate([a[2] for a in asked]) != 0
        histories, at_history = np.unique(heads, return_inverse=True)
        words, at_word = np.unique(np.concatenate([a[3] for a in asked]), return_inverse=True)
        key, which = np.unique(np.repeat(at_history, runs) * len(words) + at_word, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, which, np.concatenate([a[4] for a in asked]).astype(np.int64))
        word_counts = np.zeros(len(words), np.int64)
        word_counts[at_word] = np.concatenate([a[5] for a in asked]).astype(np.int64)
        seen = total > 0
        owner = (key // len(words))[seen]
        few = np.zeros((len(histories), MOST_DISCOUNTED), np.int64)
        small = total[seen] <= MOST_DISCOUNTED
        np.add.at(few, (owner[small], total[seen][small] - 1), 1)
        mass = np.bincount(owner, totals.p_word(word_counts[key[seen] % len(words)]), minlength=len(histories))
        found: list[tuple] = []
        entry = row = 0
        for batch, own in zip(batches, asked):
            own_runs = own[1].astype(np.int64)
            counts = total[which[entry : entry + int(own_runs.sum())]]
            lines = at_history[row : row + len(own_runs)]
            starts = np.cumsum(own_runs) - own_runs
            asks = np.add.reduceat(counts == 0, starts) > 0
            wanted = lines[asks]
            sums = [pack(few[wanted].ravel()), mass[wanted].astype("<f8").tobytes()]
            found.append((batch, totals.buckets + bucket, [pack(counts), pack(asks), *sums]))
            entry, row = entry + len(counts), row + len(lines)
        hot = np.unique(at_history[split])
        sums = np.concatenate([[0, 0], _counts_of_counts(total)])
        extra = [pack(sums), pack(histories[hot]), pack(few[hot].ravel()), mass[hot].astype("<f8").tobytes()]
        return [*found, (None, bucket, extra)]

    return answer(questions, one)


@dataclass(frozen=True)
class Hot:
    """Sums over the histories that are dealt over several buckets, at most a few per bucket; sorted."""

    words: np.ndarray
    few: np.ndarray
    mass: np.ndarray


def _hot(answers: DataFrame) -> Hot:
    got = [r[0] for r in answers.filter(F.col("batch").isNull()).select("parts").collect()]
    words = np.concatenate([np.empty(0, np.uint64), *[unpack(p[1]) for p in got]])
    few = np.concatenate([np.empty(0, np.int64), *[unpack(p[2]).astype(np.int64) for p in got]]).reshape(-1, MOST_DISCOUNTED)
    mass = np.concatenate([np.empty(0), *[np.frombuffer(p[3], "<f8") for p in got]])
    distinct, at = np.unique(words, return_inverse=True)
    few_sums, mass_sums = np.zeros((len(distinct), MOST_DISCOUNTED), np.int64), np.zeros(len(distinct))
    np.add.at(few_sums, at, few)
    np.add.at(mass_sums, at, mass)
    return Hot(distinct, few_sums, mass_sums)


def _scores(batch: Batch, answers: dict[int, list[bytes]], totals: Totals, hot: Hot) -> tuple:
    """Per document: id, held_out, n_tokens, n_known, base score, score."""
    first, second, which = batch.pairs()
    order, edges = batch.dealt(first, second, totals)
    counts = np.zeros(len(first), np.int64)
    few = np.zeros((len(batch.words), MOST_DISCOUNTED), np.int64)
    mass = np.zeros(len(batch.words))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        part = order[edges[bucket] : edges[bucket + 1]]
        got, asks, sums, masses = answers[totals.buckets + bucket]
        counts[part] = unpack(got).astype(np.int64)
        heads = np.unique(first[part])[unpack(asks) != 0]
        few[heads] = unpack(sums).astype(np.int64).reshape(-1, MOST_DISCOUNTED)
        mass[heads] = np.frombuffer(masses, "<f8")
    if len(hot.words):
        at = np.minimum(np.searchsorted(hot.words, batch.words), len(hot.words) - 1)
        is_hot = hot.words[at] == batch.words
        few[is_hot], mass[is_hot] = hot.few[at[is_hot]], hot.mass[at[is_hot]]
    r = np.arange(1, MOST_DISCOUNTED + 1)
    left = (1.0 + (few * (r * (1 - totals.bigram[1:]))).sum(axis=1)) / (batch.as_history + 1)
    backoff = left / (1.0 - mass)
    kept = counts * totals.bigram[np.where(counts <= MOST_DISCOUNTED, counts, 0)] / (batch.as_history[first] + 1)
    backed = backoff[first] * totals.p_word(batch.counts[second])
    score = np.log10(np.where(counts > 0, kept, backed))[which]
    c = batch.counts[batch.tokens]
    base = np.log10((c + 1) / (totals.tokens + totals.words + 1))
    starts = np.cumsum(batch.sizes) - batch.sizes
    add = lambda x: np.add.reduceat(x, starts)
    return batch, add((c > 0).astype(np.int64)), add(base), add(score)


def score_documents(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Rows for which ``held_out`` is false or null are counted; all are scored. A
    null or empty text is the end token alone. Repeated rows count and are scored
    again. ``buckets`` deals words and bigrams; it defaults to the session's
    shuffle partitions and grows with them. A history with over a quarter of a
    bucket's share of tokens is dealt over several buckets, so the driver gets at
    most a few sums per bucket. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    buckets = buckets or partitions(spark)
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    scanned = scan(_scan(plain, buckets), partitions(spark))
    words = cut_lineage(_count_words(scanned.questions))
    sums = _summed(words, 0)
    once = np.ones(MOST_DISCOUNTED + 1)
    totals = Totals(int(sums[0]), int(sums[1]), discounts(sums[2:]), once, buckets, sums[2 : 2 + MOST_DISCOUNTED])

    def ask(name: str, state: list[bytes], answers: dict[int, list[bytes]]) -> Iterator[list[tuple]]:
        yield _ask_bigrams(Batch.of(state, answers, totals), name, totals)

    questions = each_row(with_answers(scanned.states, words), ask, ROW, rows)
    bigrams = cut_lineage(_count_bigrams(questions, totals))
    full = replace(totals, bigram=discounts(_summed(bigrams, 0)[2:]))
    hot = _hot(bigrams)

    def score(name: str, state: list[bytes], answers: dict[int, list[bytes]]) -> Iterator[tuple]:
        yield _scores(Batch.of(state, answers, full), answers, full, hot)

    def made(found: tuple) -> pa.RecordBatch:
        batch, known, base, own = found
        n = len(known)
        columns = [
            pa.array(batch.ids, pa.int64(), mask=~batch.known),
            pa.array(batch.held),
            pa.array(batch.sizes),
            pa.array(known),
            pa.array(np.full(n, full.tokens)),
            pa.array(base),
            pa.array(own),
        ]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.record_batch(columns, names)

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return each_row(with_answers(scanned.states, words, bigrams), score, schema, made)

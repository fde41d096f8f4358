"""Phrase collocations: candidates counted by tries over numbered words.

Text becomes blocks of words of one language, and each block hands in its distinct words
once. Words that are frequent enough get numbers, which go back to the blocks by a join,
so that a block is one array of word numbers in which rare words and the borders of
pieces are zero.

Phrases then grow word by word. A phrase can only be frequent if both phrases that are
one word shorter are (Apriori), so a level looks at the text windows whose two parts were
nominated before, and nominates those that the tasks together have seen often enough.
Nominations are dealt by hash into shards of bounded size. A shard becomes a double-array
trie, which is broadcast; every task advances all positions of its blocks through it and
adds up the accepting states, and the tasks' sums are the counts. Only these count: the
scores, the covering and the order are joins and a window over them.

One shard is on its way at a time, so memory does not grow with the number of phrases;
the passes over the number arrays do, by one for every ``SHARD`` phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.double_array import DoubleArray, build, digits_of
from tidemark.llm.exchange import pack, unpack
from tidemark.operators.keys import number_rows
from tidemark.session import cut_lineage

#: Words after which a block is closed; a longer text is a block of its own.
BLOCK_WORDS = 1 << 20
#: Windows whose phrases are made distinct together before they leave a task.
WINDOWS = 1 << 22
#: Nominated phrases of a trie, on average; dealt by hash, a shard differs from that by a few thousand.
SHARD = 1 << 19
#: Phrases whose sums travel together, and tasks whose slices are added up first.
SLICE, HALF = 1 << 13, 1 << 10
#: Rows handed to Spark at a time.
ROWS = 1 << 17

# What ends a piece, and what lies between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(ord(".") if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words in order, with a full stop for every end of a piece."""
    return [*text.translate(_TABLE).replace(b".", b" . ").split(), b"."]


def text_blocks(docs: DataFrame, text_col: str, lang_col: str, unknown: str) -> DataFrame:
    """(block, lang, tokens, words, counts): ``tokens`` number the block's own ``words`` from 1; 0 ends a piece."""
    chosen = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(unknown)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def block(number: int, lang: str, tokens: list[bytes]) -> pa.RecordBatch:
        counts = Counter(tokens)
        del counts[b"."]
        common = counts.most_common()
        local = {w: k for k, (w, _) in enumerate(common, 1)} | {b".": 0}
        numbers = np.fromiter(map(local.__getitem__, tokens), np.uint64, len(tokens))
        columns = [[number], [lang], [pack(numbers)], [[w.decode() for w, _ in common]], [[n for _, n in common]]]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "lang", "tokens", "words", "counts"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                own = held.setdefault(lang, [])
                found = words_of(text.as_py())
                own += found
                size += len(found)
                full = list(held) if size >= 2 * BLOCK_WORDS else [lang] if len(own) >= BLOCK_WORDS else []
                for name in full:
                    size -= len(held[name])
                    yield block(number, name, held.pop(name))
                    number += 1
        for name, own in held.items():
            yield block(number, name, own)
            number += 1

    return chosen.mapInArrow(over, "block bigint, lang string, tokens binary, words array<string>, counts array<bigint>")


def numbered_words(blocks: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(block, ids) with one number per frequent word and language, the lexicon, and all words' counts per language."""
    seen = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "found"))
    seen = seen.select("block", "lang", (F.col("local") + 1).alias("local"), F.col("found.words").alias("word"), F.col("found.counts").alias("n"))
    words = cut_lineage(seen.groupBy("lang", "word").agg(F.sum("n").alias("f")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = number_rows(words.filter(F.col("f") >= least), ["lang", "word"], name="id")
    lexicon = cut_lineage(frequent.select(F.col("id").cast("int").alias("id"), "lang", "word", "f"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = unpack(batch.column(1)[k].as_py())
                pairs = batch.column(2)[k].values
                ids = np.zeros(int(tokens.max(initial=0)) + 1, np.uint64)
                if pairs is not None and len(pairs):
                    local, number = (x.to_numpy(zero_copy_only=False) for x in pairs.flatten())
                    ids[local] = number
                yield pa.record_batch([batch.column(0).slice(k, 1), pa.array([pack(ids[tokens])], pa.binary())], ["block", "ids"])

    pairs = seen.join(lexicon.select("lang", "word", "id"), ["lang", "word"]).groupBy("block")
    pairs = pairs.agg(F.collect_list(F.struct("local", "id")).alias("pairs"))
    encoded = blocks.select("block", "tokens").join(pairs, "block", "left").select("block", "tokens", "pairs")
    return cut_lineage(encoded.mapInArrow(over, "block bigint, ids binary")), lexicon, totals


def _columns(k: int) -> list[str]:
    return [f"w{j}" for j in range(k)]


def _distinct(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of word numbers in lexicographic order, and how often each occurs."""
    rows = np.concatenate(windows)
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[first], np.diff(np.append(first, len(rows)))


def _counted(rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    columns = [pa.array(np.ascontiguousarray(c), pa.int32()) for c in rows.T] + [pa.array(counts, pa.int64())]
    whole = pa.record_batch(columns, [*_columns(rows.shape[1]), "n"])
    for start in range(0, whole.num_rows, ROWS):
        yield whole.slice(start, ROWS)


def nominate(encoded: DataFrame, hits: DataFrame | None, k: int, least: int) -> DataFrame:
    """Phrases of ``k`` words, both parts of which are nominated, that tasks together saw ``least`` times or more.

    ``hits`` has, per block and shard, the positions where a nominated phrase of ``k - 1`` words
    begins, as bits; for pairs, every position of a frequent word is one.
    """

    marked = hits is not None

    def windows(ids: np.ndarray, bits: list[bytes] | None) -> np.ndarray:
        if bits is None:
            begins = ids > 0
        else:
            packed = reduce(np.bitwise_or, (np.frombuffer(b, np.uint8) for b in bits), np.zeros(-(-len(ids) // 8), np.uint8))
            begins = np.unpackbits(packed, count=len(ids)).view(bool)
        at = np.flatnonzero(begins[:-1] & begins[1:])
        return np.stack([ids[at + j] for j in range(k)], axis=1).astype(np.int32)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                bits = batch.column(1)[row].as_py() if marked else None
                held.append(windows(unpack(batch.column(0)[row].as_py()).astype(np.int64), bits))
                size += len(held[-1])
                if size >= WINDOWS:
                    yield from _counted(*_distinct(held))
                    held, size = [], 0
        if size:
            yield from _counted(*_distinct(held))

    schema = ", ".join(f"{c} int" for c in _columns(k)) + ", n bigint"
    if not marked:
        seen = encoded.select("ids").mapInArrow(over, schema)
    else:
        per_block = hits.groupBy("block").agg(F.collect_list("hits").alias("hits"))
        seen = encoded.join(per_block, "block").select("ids", "hits").mapInArrow(over, schema)
    often = seen.groupBy(*_columns(k)).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return cut_lineage(often.select(*_columns(k)))


def tries(nominated: DataFrame, k: int, highest: int) -> tuple[DataFrame, int]:
    """One row per shard: its double array and its phrases; and the number of shards."""
    shards = -(-nominated.count() // SHARD)

    def make(table: pa.Table) -> pa.Table:
        rows, _ = _distinct([np.stack([table.column(c).to_numpy() for c in _columns(k)], axis=1).astype(np.int64)])
        trie = build(rows, highest)
        parts = [trie.base.tobytes(), trie.check.tobytes(), trie.states.tobytes(), rows.astype(np.int32).tobytes()]
        return pa.table([table.column("shard").slice(0, 1), *(pa.array([p], pa.binary()) for p in parts)], ["shard", "base", "check", "states", "phrases"])

    # Each shard is a group of about SHARD rows, dealt by a hash of the whole phrase.
    dealt = nominated.withColumn("shard", F.pmod(F.xxhash64(*_columns(k)), F.lit(max(1, shards))).cast("int"))
    return cut_lineage(dealt.groupBy("shard").applyInArrow(make, "shard int, base binary, check binary, states binary, phrases binary")), shards


def count_through(encoded: DataFrame, row, k: int, highest: int, mark: bool) -> tuple[DataFrame, DataFrame | None]:
    """(w0, ..., n) of a shard's phrases that occur, and (block, hits) of where they begin.

    A task's sums leave it as packed slices of one array, which are added up in two steps, so
    that neither the rows nor a group's size follow the number of tasks times that of phrases.
    """
    base, check, states, phrases = (np.frombuffer(row[c], np.int32) for c in ("base", "check", "states", "phrases"))
    phrases = phrases.reshape(-1, k)
    digits, bits = digits_of(highest)
    names = ["block", "hits", "slice", "half", "sums"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = DoubleArray(base, check, states, k, digits, bits)
        total = np.zeros(len(check), np.int64)
        for batch in batches:
            for number in range(batch.num_rows):
                ids = unpack(batch.column(1)[number].as_py()).astype(np.int32)
                at, state = trie.match(ids)
                total += np.bincount(state, minlength=len(check))
                if mark:
                    begins = np.zeros(len(ids), bool)
                    begins[at] = True
                    hits = pa.array([np.packbits(begins).tobytes()], pa.binary())
                    rest = [pa.nulls(1, t) for t in (pa.int32(), pa.int32(), pa.binary())]
                    yield pa.record_batch([batch.column(0).slice(number, 1), hits, *rest], names)
        own = total[states]
        if own.any():
            starts = range(0, len(own), SLICE)
            half = TaskContext.get().partitionId() // HALF
            columns = [pa.array(range(len(starts)), pa.int32()), pa.array([half] * len(starts), pa.int32())]
            columns.append(pa.array([pack(own[i : i + SLICE]) for i in starts], pa.binary()))
            yield pa.record_batch([pa.nulls(len(starts), pa.int64()), pa.nulls(len(starts), pa.binary()), *columns], names)

    def added(table: pa.Table) -> np.ndarray:
        return reduce(np.add, (unpack(x.as_py()) for x in table.column("sums")))

    def some(table: pa.Table) -> pa.Table:
        return pa.table([table.column("slice").slice(0, 1), pa.array([pack(added(table))], pa.binary())], ["slice", "sums"])

    def all_(table: pa.Table) -> pa.Table:
        start, sums = table.column("slice")[0].as_py() * SLICE, added(table).astype(np.int64)
        found = np.flatnonzero(sums)
        return pa.Table.from_batches(_counted(phrases[start + found], sums[found]))

    schema = "block bigint, hits binary, slice int, half int, sums binary"
    written = cut_lineage(encoded.select("block", "ids").mapInArrow(over, schema))
    slices = written.filter(F.col("slice").isNotNull()).select("slice", "half", "sums")
    halves = slices.groupBy("slice", "half").applyInArrow(some, "slice int, sums binary")
    counts = halves.groupBy("slice").applyInArrow(all_, ", ".join(f"{c} int" for c in _columns(k)) + ", n bigint")
    return counts, written.filter(F.col("block").isNotNull()).select("block", "hits") if mark else None


def phrase_counts(encoded: DataFrame, highest: int, least: int, longest: int) -> dict[int, DataFrame]:
    """Per length from 2 to ``longest``: (w0, ..., n) of all phrases with ``n >= least``."""
    found: dict[int, DataFrame] = {}
    hits = None
    for k in range(2, longest + 1):
        rows, shards = tries(nominate(encoded, hits, k, least), k, highest)
        passes = [
            count_through(encoded, rows.filter(F.col("shard") == s).first(), k, highest, mark=k < longest)
            for s in range(shards)
        ]
        if not passes:
            break
        # A phrase is in one shard, so the shards' counts stand side by side.
        counts = reduce(DataFrame.unionByName, [c for c, _ in passes])
        found[k] = cut_lineage(counts.filter(F.col("n") >= least))
        if k < longest:
            hits = reduce(DataFrame.unionByName, [h for _, h in passes])
    return found


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in whole decimals."""
    whole = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast(1000000 as decimal(38,0)) * {whole(a)} * {whole(a)}) div ({whole(left)} * {whole(right)})")


def scored(found: dict[int, DataFrame], lexicon: DataFrame, cover: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all phrases that no longer one covers by ``cover`` percent."""
    counts = {1: lexicon.select(F.col("id").alias("w0"), F.col("f").alias("n")), **found}
    made = []
    for k, phrases in found.items():
        rows = phrases.withColumnRenamed("n", "a")
        for longer in [x for x in found if x > k]:
            inside = [
                found[longer].select(*[F.col(f"w{j + s}").alias(f"w{j}") for j in range(k)], F.col("n").alias("most"))
                for s in range(longer - k + 1)
            ]
            most = reduce(DataFrame.unionByName, inside).groupBy(*_columns(k)).agg(F.max("most").alias("most"))
            rows = rows.join(most, _columns(k), "left").filter(F.expr(f"most is null or 100 * most < {cover} * a")).drop("most")
        for cut in range(1, k):
            left = counts[cut].withColumnRenamed("n", f"l{cut}")
            right = counts[k - cut].select(*[F.col(f"w{j}").alias(f"w{j + cut}") for j in range(k - cut)], F.col("n").alias(f"r{cut}"))
            rows = rows.join(left, _columns(cut)).join(right, [f"w{j + cut}" for j in range(k - cut)])
        cuts = [F.struct(_score("a", f"l{c}", f"r{c}").alias("score"), F.lit(c).alias("k"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        for j in range(k):
            named = [F.col("id").alias(f"w{j}"), F.col("word").alias(f"word{j}")] + ([F.col("lang")] if j == 0 else [])
            rows = rows.join(lexicon.select(*named), f"w{j}")
        phrase = F.concat_ws(" ", *[f"word{j}" for j in range(k)])
        made.append(rows.select("lang", phrase.alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    return reduce(DataFrame.unionByName, made)


def collocations(
    docs: DataFrame,
    least: int = 10,
    longest: int = 3,
    top: int = 2000,
    cover: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    unknown: str = "und",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z) and split into pieces at ``ENDS`` and into words at blanks and
    tabs. ``a`` counts all occurrences of a phrase inside pieces, overlaps included, ``n`` all
    words of the language; phrases with ``a >= least`` are candidates. The cut of a candidate
    into two parts with counts l and r that scores floor(1000000 a a / (l r)) lowest counts, of
    equal ones the earliest. A candidate inside a longer one that has ``cover`` percent of its
    count or more is left out. Order: score, then a, descending, then the phrase in byte order.

    A null text is empty, a null language is ``unknown``; repeated rows count each; ids and
    other columns are not read; no candidate, as in an empty table, gives no rows.
    """
    blocks = cut_lineage(text_blocks(docs, text_col, lang_col, unknown))
    encoded, lexicon, totals = numbered_words(blocks, least)
    highest = lexicon.agg(F.max("id")).first()[0] or 0
    found = phrase_counts(encoded, highest, least, longest) if highest else {}
    if found:
        rows = scored(found, lexicon, cover)
    else:
        rows = docs.sparkSession.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, score bigint")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

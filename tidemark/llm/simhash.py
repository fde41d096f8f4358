"""SimHash fingerprints and near-duplicate components by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, id_and_text, with_field
from tidemark.llm.graph import components
from tidemark.session import cut_lineage

#: Shingles whose bits are counted at a time.
SHINGLES_AT_A_TIME = 1 << 14


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Hashes of the shingles of a text in order, repeats included.

    A-Z is lowered; shingles are ``width`` words joined by single blanks; a shorter
    text is one shingle, a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[:-1])]
    ends = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], dtype="<u8")


def fingerprint_of(hashes: np.ndarray) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the hashes; zero without any."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), SHINGLES_AT_A_TIME):
        block = hashes[start : start + SHINGLES_AT_A_TIME].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash of the shingles of a text; a text without words gives zero."""
    return fingerprint_of(shingle_hashes(text, width))


def _bodies(texts: pa.Array) -> pa.Array:
    """A 64-bit hash of each text; null is empty."""
    return pa.array(np.array([xxhash.xxh64_intdigest(t.as_py() or "") for t in texts], np.uint64).view(np.int64))


def fingerprints(
    docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", with_body: bool = False
) -> DataFrame:
    """(doc_id, fp bigint), one row per input row; ``body`` adds a hash of the text. A null text has no words."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint((t.as_py() or "").encode(), width) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(np.array(made, np.uint64).view(np.int64))]
            if with_body:
                columns.append(_bodies(batch.column(1)))
            yield pa.record_batch(columns, names)

    names = ["doc_id", "fp", "body"] if with_body else ["doc_id", "fp"]
    return id_and_text(docs, id_col, text_col).mapInArrow(over, ", ".join(f"{c} bigint" for c in names))


def block_masks(blocks: int, bits: int) -> list[int]:
    """Masks of all choices of ``blocks - bits`` blocks: values within ``bits`` bits agree on at least one of them."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(single, blocks - bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within ``bits`` bits."""
    patterns = values.view(np.uint64)  # signed numbers are counted by their absolute value
    if len(values) == 2:
        return [(int(values[0]), int(values[1]))] if int(np.bitwise_count(patterns[0] ^ patterns[1])) <= bits else []
    rest, edges = np.arange(len(values)), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(patterns[rest] ^ patterns[node]) <= bits
            edges += [(int(values[node]), int(values[i])) for i in rest[near]]
            queue += rest[near].tolist()
            rest = rest[~near]
    return edges


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _worth_a_look(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int, small: int = 8) -> np.ndarray:
    """Which runs can hold a link: small ones with two values close to each other, and all larger ones."""
    patterns = values.view(np.uint64)
    run = np.repeat(np.arange(len(starts)), sizes)
    found = sizes > small
    for step in range(1, small):
        close = np.bitwise_count(patterns[step:] ^ patterns[:-step]) <= bits
        close &= run[step:] == run[:-step]
        found[run[step:][close]] = True
    return found


def _meeting_edges(grouped: DataFrame, bits: int, chunk: int | None) -> DataFrame:
    """(a, b, hot) from (meet, fp): links of each group, or with ``hot`` the rows of a group above ``chunk``.

    A task streams its sorted rows and holds one batch and the group that is open;
    rows of a group that has grown above ``chunk`` are passed on unseen.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(a: list | np.ndarray, b: list | np.ndarray, hot: bool) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64)), pa.array(np.full(len(a), hot))],
                ["a", "b", "hot"],
            )

        def closed(m: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts, sizes = _runs(m)
            look = _worth_a_look(v, starts, sizes, bits)
            edges: list[tuple[int, int]] = []
            for at, size in zip(starts[look].tolist(), sizes[look].tolist()):
                if chunk is None or size <= chunk:
                    edges += _forest(v[at : at + size], bits)
                else:
                    yield made(m[at : at + size], v[at : at + size], True)
            if edges:
                pairs = np.array(edges, np.int64)
                yield made(pairs[:, 0], pairs[:, 1], False)

        meets, fps, passing = np.empty(0, np.int64), np.empty(0, np.int64), None
        for batch in batches:
            meets = np.concatenate([meets, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if passing is not None:
                n = int(np.searchsorted(meets, passing, side="right"))
                if n:
                    yield made(meets[:n], fps[:n], True)
                passing = passing if n == len(meets) else None
                meets, fps = meets[n:], fps[n:]
            if len(meets):
                done = int(np.searchsorted(meets, meets[-1]))  # the last group may go on in the next batch
                yield from closed(meets[:done], fps[:done])
                meets, fps = meets[done:], fps[done:]
                if chunk is not None and len(meets) > chunk:
                    yield made(meets, fps, True)
                    passing, meets, fps = meets[-1], meets[:0], fps[:0]
        if len(meets):
            yield from closed(meets, fps)

    dealt = grouped.repartition("meet").sortWithinPartitions("meet")
    return dealt.mapInArrow(over, "a bigint, b bigint, hot boolean")


def dealt_in_chunks(rows: DataFrame, key: str, item: str, chunk: int) -> DataFrame:
    """``rows`` with a column ``meet``: each two chunks of a key's items meet in one group of bounded size.

    Items are dealt by hash into as many chunks as the key's count asks for; a row
    stands once for each chunk that its own meets. Any two items of a key share at
    least one group. The counts are combined before their shuffle, and the join of
    a key with its count can be split.
    """
    counts = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64(item), F.col("chunks")).cast("int")
    return (
        rows.join(counts, key)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("meet", F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")))
        .drop("chunks", "mine", "other")
    )


def linked_values(values: DataFrame, bits: int = 4, blocks: int = 7, chunk: int = 1024) -> DataFrame:
    """Links (a, b) that connect all distinct 64-bit ``fp`` values within ``bits`` differing bits.

    Close values agree on ``blocks - bits`` whole blocks, so every choice of so
    many blocks is a join key. A key with more than ``chunk`` values is dealt into
    chunks, and each two chunks meet as one group of bounded size, so no group
    holds a whole hot key. A group yields the edges of a spanning forest over its
    true links: as many connections as all pairs, but fewer rows than values.
    """
    masks = block_masks(blocks, bits)
    meets = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    return linked_meetings(values.select(F.explode(meets).alias("meet"), "fp"), bits, chunk)


def linked_meetings(meetings: DataFrame, bits: int, chunk: int = 1024) -> DataFrame:
    """Links (a, b) that connect the ``fp`` values within ``bits`` bits of each ``meet``; large ones are dealt in chunks."""
    first = cut_lineage(_meeting_edges(meetings, bits, chunk))
    hot = first.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    second = _meeting_edges(dealt_in_chunks(hot, "key", "fp", chunk).select("meet", "fp"), bits, None)
    return first.filter("not hot").select("a", "b").unionByName(second.select("a", "b")).distinct()


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    bits: int = 4,
    blocks: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Documents whose fingerprints differ in at most ``bits`` bits are linked, and
    linked documents share the smallest doc_id they reach. Texts without words
    have fingerprint zero and link like any other. Copies have one fingerprint and
    enter the search once. A null id takes part, but a component is named by its
    ids only (null if it has none). More ``blocks`` mean more join keys that are
    each shared by fewer chance neighbours: raise it with the corpus.
    """
    marked = cut_lineage(fingerprints(docs, width, id_col, text_col))
    values = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = components(linked_values(values.select("fp"), bits, blocks))
    named = values.join(groups, values["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = cut_lineage(named)
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(names, "component").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(known, F.col("fp") == F.col("_fp"), "left").drop("_fp")


def keep_one(
    docs: DataFrame,
    width: int = 5,
    bits: int = 6,
    blocks: int = 9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs``, all columns, with one document of every near-duplicate component: the first by doc_id.

    A document is its id and text: rows that repeat both stay or go together. Null
    ids come last, equal ids are ordered by fingerprint and text hash. Texts
    without words are one component, as their fingerprints are equal.
    """
    marked = cut_lineage(fingerprints(docs, width, id_col, text_col, with_body=True))
    values = cut_lineage(marked.select("fp").distinct())
    groups = components(linked_values(values, bits, blocks))
    body, number, of = fresh(docs, "own_body", "kept_id", "kept_body")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "body")
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = (
        first.join(groups, first["fp"] == groups["node"], "left")
        .groupBy(F.coalesce("component", "fp").alias("component"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias(number), F.col("first.body").alias(of))
    )
    at, names = docs.columns.index(text_col), docs.columns

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns, _bodies(batch.column(at))], [*names, body])

    return (
        docs.mapInArrow(hashed, with_field(docs.schema, body, T.LongType()))
        .join(chosen, F.col(id_col).cast("bigint").eqNullSafe(F.col(number)) & (F.col(body) == F.col(of)), "left_semi")
        .select(*names)
    )

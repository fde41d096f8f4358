"""Vector codes: a codebook per part of a vector, nearest entries found behind pivots.

Vectors become integers, are cut into equal parts, and each part is replaced by the
number of its nearest codebook entry. The search is LAESA's: some fixed pivots per part
position are chosen once, and every part's distances to them are computed and stored
once. In a round only the entries' distances to the pivots are new; by the triangle
inequality the largest difference between the two is a lower bound of the distance to
an entry. Entries are tried in the order of their bounds, and only while a bound does
not exceed the best exact integer distance so far, so most are never evaluated.

The parts live in a written table that each round reads once; a task returns its sums
per entry, a table of fixed size, and only their totals reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches
from tidemark.session import cut_lineage

#: Components are floors of this times the given ones.
SCALE = 256
#: Pivots per part position.
PIVOTS = 5
#: Vectors whose bounds are held at a time.
ROWS_AT_A_TIME = 4096
#: Share of the two distances that rounding may take off a bound; floats of 32 bits are off by 2**-24 at most.
SLACK = np.float32(2.0**-21)


def whole(vectors: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vector array<double>) of vectors that hold finite numbers only and divide into ``parts``."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector"))
    return given.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite)


def integers(flat: np.ndarray, width: int) -> np.ndarray:
    """Floors of scaled components, if squared distances of whole vectors fit into 64 bits."""
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    most = math.isqrt((1 << 63) // (4 * width)) - 1
    if len(scaled) and np.abs(scaled).max() > most:
        raise ValueError(f"components beyond {most // SCALE} have no exact 64-bit distances")
    return scaled.astype(np.int32)


def first_vectors(given: DataFrame, n: int) -> np.ndarray:
    """The ``n`` vectors of smallest id (ties by the vectors; null ids last) that are as long as the first of them."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    rows = given.orderBy(*order).limit(n).collect()
    if rows and any(len(r.vector) != len(rows[0].vector) for r in rows):
        rows = given.filter(F.size("vector") == len(rows[0].vector)).orderBy(*order).limit(n).collect()
    if not rows:
        return np.empty((0, 0), np.int32)
    return integers(np.array([r.vector for r in rows]).ravel(), len(rows[0].vector)).reshape(len(rows), -1)


def by_part(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(vectors, width) as (parts, vectors, width of a part), in 64 bits."""
    return np.ascontiguousarray(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)).astype(np.int64)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    step = a - b
    return np.einsum("...i,...i->...", step, step)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(parts, points, width) to (parts, points, pivots), rounded to 32 bits."""
    far = [np.sqrt(squares(points, pivots[:, None, k])).astype(np.float32) for k in range(pivots.shape[1])]
    return np.stack(far, axis=2) if far else np.zeros((*points.shape[:2], 0), np.float32)


def choose_pivots(entries: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` entries of each part position, each the furthest from those before it; the first is entry 0."""
    chosen = []
    for own in entries:
        picks, near = [0], squares(own, own[0])
        while len(picks) < min(most, len(own)):
            picks.append(int(near.argmax()))
            near = np.minimum(near, squares(own, own[picks[-1]]))
        chosen.append(own[picks])
    return np.stack(chosen)


def nearest(points: np.ndarray, far: np.ndarray, entries: np.ndarray, entry_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (lower number on ties), its exact squared distance, and how many distances were evaluated.

    ``far`` and ``entry_far`` are the points' and entries' distances to the pivots of one part position.
    """
    bound = np.zeros((len(points), len(entries)), np.float32)
    for k in range(far.shape[1]):
        a, b = far[:, k, None], entry_far[None, :, k]
        np.maximum(bound, np.abs(a - b) - (a + b) * SLACK, out=bound)
    index = np.zeros(len(points), np.int64)
    best = np.full(len(points), np.iinfo(np.int64).max)
    rows = np.arange(len(points))
    evaluated = 0
    while len(rows):
        entry = bound.argmin(axis=1)
        least = bound[np.arange(len(rows)), entry].astype(np.float64)
        open_ = least * least <= best[rows]  # equal bounds stay open: a tie may go to a lower number
        if not open_.all():
            rows, entry, bound = rows[open_], entry[open_], bound[open_]
        found = squares(points[rows], entries[entry])
        evaluated += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (entry < index[rows]))
        index[rows[better]], best[rows[better]] = entry[better], found[better]
        bound[np.arange(len(rows)), entry] = np.inf
    return index, best, evaluated


@dataclass(frozen=True)
class Codebooks:
    """Entries (parts, entries, width) and the pivots that the stored distances belong to."""

    entries: np.ndarray
    pivots: np.ndarray

    @property
    def sha256(self) -> str:
        """Of all decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assigner(self):
        """A function from a batch of stored rows to (part components, numbers, squared distances) of blocks of it."""
        entries, parts = self.entries, len(self.entries)
        entry_far = distances(entries, self.pivots)

        def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(start, ROWS_AT_A_TIME)
                points = by_part(_stacked(part, "components", np.int32), parts)
                far = by_part(_stacked(part, "far", np.int32), parts).astype(np.int32).view(np.float32)
                found = [nearest(points[p], far[p], entries[p], entry_far[p])[:2] for p in range(parts)]
                yield points, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

        return blocks


def _stacked(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name)).to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def stored_parts(given: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, label, components, far) of each vector: its integers and its parts' distances to the pivots, written once."""
    parts, _, size = pivots.shape
    width = parts * size
    kinds = T.StructType([given.schema["vec_id"], given.schema["label"], T.StructField("components", T.BinaryType()), T.StructField("far", T.BinaryType())])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        vectors = integers(flat, width).reshape(-1, width)
        far = distances(by_part(vectors, parts), pivots).transpose(1, 0, 2)
        blobs = [pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary()) for x in (vectors, far)]
        return pa.record_batch([batch.column(0), batch.column(1), *blobs], ["vec_id", "label", "components", "far"])

    return cut_lineage(map_batches(given.filter(F.size("vector") == width), one, kinds))


def better(stored: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry to the floor of its parts' mean; unused ones stay."""
    parts, n, size = books.entries.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = books.assigner()
        count, sums = np.zeros((parts, n), np.int64), np.zeros((parts, n, size), np.int64)
        for batch in batches:
            for points, numbers, _ in assign(batch):
                for p in range(parts):
                    count[p] += np.bincount(numbers[:, p], minlength=n)
                    np.add.at(sums[p], numbers[:, p], points[p])
        part, entry = np.nonzero(count)
        columns = [part.astype(np.int32), entry.astype(np.int32), count[part, entry], *sums[part, entry].T]
        if len(part):
            yield pa.record_batch([pa.array(c) for c in columns], ["part", "entry", "n", *(f"s{k}" for k in range(size))])

    schema = "part int, entry int, n bigint" + "".join(f", s{k} bigint" for k in range(size))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (
        stored.select("components", "far")
        .mapInArrow(totals, schema)
        .groupBy("part", "entry")
        .agg(total("n"), *(total(f"s{k}") for k in range(size)))
        .collect()  # parts x entries rows at most
    )
    entries = books.entries.copy()
    for row in rows:
        entries[row.part, row.entry] = [int(row[f"s{k}"]) // int(row.n) for k in range(size)]
    return Codebooks(entries, books.pivots)


def encode(stored: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of each stored vector; ``code`` has two hex digits a part."""
    kinds = T.StructType([stored.schema["vec_id"], stored.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = books.assigner()
        for batch in batches:
            codes, errors = [], []
            for _, numbers, found in assign(batch):
                codes += [row.tobytes().hex() for row in numbers.astype(np.uint8)]
                errors.append(found.sum(axis=1))
            if codes:
                columns = [batch.column(0), batch.column(1), pa.array(codes), pa.array(np.concatenate(errors))]
                yield pa.record_batch(columns, ["vec_id", "label", "code", "error"])

    return stored.mapInArrow(over, kinds)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the errors summed over its label, null labels together.

    One row per label and task is shuffled; Spark broadcasts the sums if their written size
    allows, else it splits the rows of a hot label in the join.
    """
    coded = cut_lineage(coded)
    sums = cut_lineage(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")))
    sums = sums.withColumnRenamed("label", "own_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("own_label")), "left").drop("own_label")


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of all usable vectors, and the codebooks behind the codes.

    Vectors that are null or empty, hold a null or a number that is not finite, do not
    divide into ``parts``, or are not as long as the usable one of smallest id, are dropped.
    Codebooks start as the parts of the ``entries`` vectors of smallest id (at most 256;
    fewer vectors, fewer entries; repeated ids count each, ordered by vector; null ids come
    last) and are bettered ``rounds`` times. Rows that repeat stay; null ids and labels stay;
    other columns are not carried. No usable vector gives no rows and empty codebooks.
    Components so large that distances need more than 64 bits are an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits number at most 256 entries")
    given = whole(vectors, parts, id_col, vector_col, label_col)
    first = first_vectors(given, entries)
    if not len(first):
        empty = given.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return empty, Codebooks(np.empty((parts, 0, 0), np.int64), np.empty((parts, 0, 0), np.int64))
    start = by_part(first, parts)
    books = Codebooks(start, choose_pivots(start, PIVOTS))
    stored = stored_parts(given, books.pivots)
    for _ in range(rounds):
        books = better(stored, books)
    return encode(stored, books), books


def decode(coded: DataFrame, books: Codebooks, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(vec_id, vector array<double>) that the codes stand for, in the given scale; a null code gives a null vector."""
    entries = books.entries

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for code in batch.column(1).to_pylist():
            numbers = None if code is None else np.frombuffer(bytes.fromhex(code), np.uint8)
            made.append(None if code is None else (entries[np.arange(len(entries)), numbers].ravel() / SCALE).tolist())
        return pa.record_batch([batch.column(0), pa.array(made, pa.list_(pa.float64()))], ["vec_id", "vector"])

    chosen = coded.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(code_col).alias("code"))
    return map_batches(chosen, one, "vec_id bigint, vector array<double>")

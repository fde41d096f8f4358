"""Questions from batches of documents to key buckets, and the answers back.

Per-token work on a corpus meets its statistics by key. Instead of a row per
token, a batch of documents asks each bucket of keys once for every distinct key
that it has, so a key that fills a third of the corpus is one entry per batch, and
a bucket answers each batch in the order asked. Questions and answers are packed
integer arrays; Spark deals, sorts and stores them as rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir
from tidemark.sources.tables import remove

#: A row is the state of a batch (bucket -1), a question or an answer; ``parts`` are packed arrays.
ROW = "batch string, bucket int, parts array<binary>"
_ARROW = pa.schema([("batch", pa.string()), ("bucket", pa.int32()), ("parts", pa.list_(pa.binary()))])
STATE = -1

_squeeze = zstandard.ZstdCompressor(level=1)
_expand = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit integers byte by byte: the lowest bytes of all, then the next, up to the highest in use."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + len(values).to_bytes(8, "little") + _squeeze.compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    made = np.zeros((size, 8), np.uint8)
    if width and size:
        raw = _expand.decompress(data[9:], max_output_size=width * size)
        made[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, size).T
    return made.view("<u8").ravel()


def rows(found: list[tuple[str | None, int, list[bytes]]]) -> pa.RecordBatch:
    batch, bucket, parts = zip(*found) if found else ((), (), ())
    return pa.record_batch(
        [pa.array(batch, pa.string()), pa.array(bucket, pa.int32()), pa.array(parts, pa.list_(pa.binary()))],
        schema=_ARROW,
    )


def each_row(
    df: DataFrame, function: Callable[[str, list[bytes], dict[int, list[bytes]]], Iterator[tuple]], schema: str, made: Callable
) -> DataFrame:
    """``function(batch, state, answers by bucket)`` over rows of (batch, parts, answers); ``made`` builds a batch of its results."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for several in batches:
            for i in range(several.num_rows):
                batch, parts, answers = (several.column(k)[i].as_py() for k in range(3))
                yield from map(made, function(batch, parts, {a["bucket"]: a["parts"] for a in answers or ()}))

    return df.select("batch", "parts", "answers").mapInArrow(over, schema)


def answer(questions: DataFrame, function: Callable[[int, list[str], list[list[bytes]]], list[tuple]]) -> DataFrame:
    """Rows that ``function(bucket, batches, parts)`` gives for all questions to a bucket together."""

    def one(table: pa.Table) -> pa.Table:
        found = function(table.column(1)[0].as_py(), table.column(0).to_pylist(), table.column(2).to_pylist())
        return pa.Table.from_batches([rows(found)])

    return questions.select("batch", "bucket", "parts").groupBy("bucket").applyInArrow(one, ROW)


@dataclass(frozen=True)
class Scan:
    """The written states of all batches, dealt by batch so that answers join without moving them, and first questions."""

    states: DataFrame
    questions: DataFrame
    path: str

    def drop_questions(self) -> None:
        """Remove the questions from the disk, when they have been answered."""
        remove(self.states.sparkSession, f"{self.path}/is_state=false")


def scan(batches: DataFrame, n: int) -> Scan:
    """Write rows of states and questions to the checkpoint folder, states dealt into ``n`` buckets by batch."""
    spark = batches.sparkSession
    name = f"scan_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/{name}"
    marked = batches.withColumn("is_state", F.col("bucket") == STATE)
    marked.write.partitionBy("is_state").bucketBy(n, "batch").option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    return Scan(
        table.filter("is_state").select("batch", "parts"),
        table.filter("not is_state").select("batch", "bucket", "parts"),
        path,
    )


def with_answers(states: DataFrame, *answers: DataFrame) -> DataFrame:
    """(batch, parts, answers) of each state with all its answers; an answer frame may follow several questions."""
    if not answers:
        return states.withColumn("answers", F.lit(None).cast("array<struct<bucket:int,parts:array<binary>>>"))
    together = answers[0]
    for more in answers[1:]:
        together = together.unionByName(more)
    gathered = (
        together.filter(F.col("batch").isNotNull())
        .groupBy("batch")
        .agg(F.collect_list(F.struct("bucket", "parts")).alias("answers"))
    )
    return states.join(gathered, "batch", "left")


def pack_sorted(values: np.ndarray) -> bytes:
    """As ``pack``, for ascending values: the steps between them take fewer bytes."""
    return pack(np.diff(values, prepend=values[:1] * 0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def ordered(ids: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def least_by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the least value of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], values[first]


def edges_by_range(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket's share of ascending keys of so many bits begins, and the end."""
    owner = ((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(buckets + 1, dtype=np.uint64))

"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of bytes other than the six ASCII blanks. ``bytes.split()``
#: cuts at exactly these six, and UTF-8 never uses them inside a character.
WORD_GAP = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators read, under fixed names; a null text becomes empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of each text of a batch, one at a time; null is empty."""
    for value in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()):
        yield value.as_py() or b""


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType
) -> DataFrame:
    """``function`` over every Arrow batch; it may return no batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            if made is not None and made.num_rows:
                yield made

    return df.mapInArrow(over, schema)


def with_let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Inside a lambda a plain expression would be evaluated anew for each element;
    as the variable of a one-element transform it is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names built from ``names`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A copy of ``schema`` with one more field."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count, which operators size their buckets by."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed unsigned 64-bit hash of 64-bit integers (the finaliser of a splitmix generator)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

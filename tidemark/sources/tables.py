"""Parquet tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: lines of a landed text file, some tens of megabytes of text.
LINES_PER_FILE = 50_000


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read one parquet table; zone-less timestamps become UTC instants.

    The cast is a projection on top of the scan, so filters on other columns are
    still pushed down and unread columns are still pruned.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a model as a table and return a read of it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table, creating it on first use."""
    df.write.mode("append").parquet(path)


def _located(spark: SparkSession, path: str):
    """The file system that owns ``path``, and the path as it knows it."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds anything, asked of the file system that owns it."""
    system, location = _located(spark, path)
    return system.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; one that is not there is no error."""
    system, location = _located(spark, path)
    system.delete(location, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table with a fixed schema, or an empty one when it is not there yet."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def landing(df: DataFrame) -> DataFrameWriter:
    """Writer of landed text or JSON files, gzipped.

    JSON repeats its field names in every line, so it takes a small part of the disk this
    way. A gzipped file is read by one task as a whole, so a file has a bounded number of
    lines.
    """
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Write a table whose files, by number, and rows within them follow ``order``.

    Ranges of the order are dealt to tasks after a sample of it, so hand in a written frame;
    rows that are equal in ``order`` share a task.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_numbered(spark: SparkSession, path: str, schema: T.StructType, name: str = "position") -> DataFrame:
    """Rows of an ordered table with their place in it, from 1; only the files' sizes are added up in one place."""
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    rows = spark.read.schema(schema).parquet(path).select(
        "*", F.struct(number.alias("n"), "_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn(name, F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_start")

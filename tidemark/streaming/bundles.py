"""Bundle pages as a file stream into the request table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import written_once
from tidemark.sources.bundles import BUNDLE_SCHEMA, flatten_bundles
from tidemark.sources.upsert import KeyedTable


def bundle_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Newly landed pages under ``path``."""
    return (
        spark.readStream.schema(BUNDLE_SCHEMA)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def keep_newest(batch: DataFrame, table: KeyedTable) -> None:
    """Upsert one micro-batch; a re-delivered or older version changes nothing.

    The newer of two versions has the later ``meta_lastupdated``, of equal ones the higher
    ``meta_versionid`` (as text).
    """
    if batch.isEmpty():
        return
    age = ("meta_lastupdated", "meta_versionid")
    if table.folders():
        known = table.read().select("id", F.struct(*age).alias("_known"))
        newer = batch.join(known, "id", "left").filter(F.col("_known").isNull() | (F.struct(*age) > F.col("_known")))
        batch = newer.drop("_known")
    with written_once(table.prepared(batch)) as fresh:
        table.merge(fresh, [F.col(c).desc_nulls_last() for c in age])


def stream_into(table: KeyedTable, pages: DataFrame, checkpoint: str) -> StreamingQuery:
    """Run everything that has landed through the upsert, then stop.

    The checkpoint remembers which files were taken; since ``keep_newest`` gives
    the same table when a batch is repeated, each change takes effect once.
    """
    flat = flatten_bundles(pages, F.current_timestamp())
    return (
        flat.writeStream.foreachBatch(lambda batch, _: keep_newest(batch, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

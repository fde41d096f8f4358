import os
import time

from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _shuffles(spark):
    """Ids of the shuffles that have files on the disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    names = [f for folder in folders for _, _, files in os.walk(folder.getPath()) for f in files]
    return {int(f.split("_")[1]) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_written_frame_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffles(spark), spark.conf.get(setting)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    written = cut_lineage(rows.groupBy("k").agg(F.sum("id").alias("n")).repartition(2, "n"))
    deadline = time.time() + 10  # files are removed beside the driver's work
    while _shuffles(spark) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not _shuffles(spark) - before
    assert spark.conf.get(setting) == was
    assert written.agg(F.sum("n")).first()[0] == 499_500

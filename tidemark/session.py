"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import remove

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", cpus: int | None = None) -> SparkSession:
    """Session for tests and the bench: UTC, AQE on, partitions by core count.

    On a cluster the launcher's own session is used instead; no operator in the
    package depends on a setting made here except the UTC session zone.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "0")) or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        # Call sites for error messages cost several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the session's, else a test-only one.

    A machine-local folder is lost together with the machine, so it is only
    ever chosen in local mode, and it is removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the files.

    Used where one frame feeds several branches of the same plan, so that it is
    neither computed twice nor lost with an executor. A table and not an RDD
    checkpoint, so that later reads are pruned to their columns and the planner
    knows the size it may broadcast. ``path``, by default a new one, is for callers that
    remove the files when they are done; see ``written_once``. Shuffle files that the writing
    made are removed after it.
    """
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run in the block go as soon as it is done.

    Otherwise they stay until the driver happens to collect its garbage, so that a job of many
    steps has most of them on the disk at once. Only for steps whose result is written.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """``cut_lineage`` for a frame that nobody reads after the block, which then is removed from the disk."""
    path = f"{checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    try:
        yield cut_lineage(df, path)
    finally:
        remove(df.sparkSession, path)

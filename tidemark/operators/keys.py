"""Row selection, joins and numbering by key."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in ``order``.

    Planned as a ``WindowGroupLimit``: each map task keeps one row per key before
    the shuffle, so a key holding most of the table still moves one row per task.
    Give null placement and a final tie-break in ``order``.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    row_id: Sequence[str],
    condition: Column | None = None,
    spread: int | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Left equi-join that spreads rows without a key over many tasks.

    Rows whose key is null can match nothing, yet they would all hash to one
    task. They get a salt taken from ``row_id``, one of ``spread`` (by default four
    per shuffle partition of the session); the right side's salt is always zero
    (written so that it is not folded away), so results are unchanged. Hot non-null
    keys are left to AQE's skew-join split.

    Joins in a row on one key can share a shuffle: give them one ``salt``, the name
    of a column that is made by the first and stays. For a key that is never null
    ``salt=""`` leaves the salt out altogether.

    ``on`` maps left names to right names; right key columns are dropped.
    ``condition`` may add predicates over both sides.
    """
    spread = spread or 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    missing = F.lit(False)
    for name in pairs:
        missing = missing | F.col(name).isNull()
    name_of_salt = "_salt" if salt is None else salt
    salted = left
    if name_of_salt and name_of_salt not in left.columns:
        share = F.pmod(F.xxhash64(*row_id), F.lit(spread))
        salted = left.withColumn(name_of_salt, F.when(missing, share).otherwise(F.lit(0).cast("bigint")))
    renamed = right
    for name in pairs.values():
        renamed = renamed.withColumnRenamed(name, f"_right_{name}")
    matches = F.lit(True)
    if name_of_salt:
        renamed = renamed.withColumn(
            "_right_salt", F.pmod(F.xxhash64(*[f"_right_{n}" for n in pairs.values()]), F.lit(1))
        )
        matches = F.col(name_of_salt) == F.col("_right_salt")
    for name, other in pairs.items():
        matches = matches & (F.col(name) == F.col(f"_right_{other}"))
    if condition is not None:
        matches = matches & condition
    return salted.join(renamed, matches, "left").drop(
        "_salt", "_right_salt", *[f"_right_{n}" for n in pairs.values()]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (fan-out report)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def number_rows(df: DataFrame, by: Sequence[str], name: str = "row_nbr", buckets: int | None = None) -> DataFrame:
    """Number all rows from 1 without ever sorting them in one task.

    Rows are ordered by the MD5 of ``by`` (then by the columns themselves). Its
    leading hex digits cut that order into even buckets, at least ``buckets`` of
    them (by default 16 per shuffle partition of the session); rows are numbered
    inside their bucket and shifted by the running size of the buckets before it.
    Only the per-bucket counts are ordered as a whole.
    """
    buckets = buckets or 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hex_digits = max(1, math.ceil(math.log(buckets, 16)))
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])
    hashed = df.withColumn("_hash", F.md5(text)).withColumn("_bucket", F.substring("_hash", 1, hex_digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *by)
    numbered = hashed.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(shifts, "_bucket")
        .withColumn(name, F.col("_shift") + F.col("_inside"))
        .drop("_hash", "_bucket", "_inside", "_shift")
    )

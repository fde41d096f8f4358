"""Validity intervals: daily expansion, point-in-time and nearest-interval joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import left_join


def calendar_days(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))


def calendar_of(df: DataFrame, day: Column) -> DataFrame:
    """Calendar that spans the days found in ``df``."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("date"))


def expand_days(
    df: DataFrame,
    start: str,
    ends: Sequence[str],
    calendar: DataFrame,
    day: str = "day_date",
    last: Column | None = None,
    contiguous: bool = False,
) -> DataFrame:
    """One row per calendar day ``d`` with ``start <= d < every end``.

    A null end is open and a null start gives no day. Intervals are clipped to
    the calendar (and to ``last``, if given) before they are exploded, so no day is
    compared with an interval it lies outside of; days between that the calendar
    does not list are then dropped. ``contiguous`` says that it lists every day
    from its first to its last, which saves that step.
    """
    bounds = calendar.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last")).alias("b")).scalar()
    first_day, last_day = bounds["first"], bounds["last"]
    bounded = df.withColumn("_from", F.greatest(F.col(start), first_day)).withColumn(
        "_until",
        F.least(*[F.col(e) for e in ends], F.date_add(last_day, 1),
                *([] if last is None else [F.date_add(last, 1)])),
    )
    # A sequence runs backwards when its end lies before its start.
    kept = bounded.filter(F.col(start).isNotNull() & (F.col("_from") < F.col("_until")))
    days = kept.withColumn(day, F.explode(F.sequence("_from", F.date_sub("_until", 1))))
    days = days.drop("_from", "_until")
    if not contiguous:
        days = days.join(calendar.select(F.col("date").alias(day)).distinct(), day, "left_semi")
    return days


def point_in_time_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    at: Column,
    valid_from: str,
    valid_through: str,
    row_id: Sequence[str],
    salt: str | None = None,
) -> DataFrame:
    """Left join to the row valid at an instant; both bounds belong to the interval.

    An instant on the border of two adjoining intervals matches both. Columns
    ``valid_from`` and ``valid_through`` must not exist on the left.
    """
    valid = at.between(F.col(valid_from), F.col(valid_through))
    return left_join(left, right, on, row_id, valid, salt=salt)


def nearest_pauses(
    state: DataFrame, pauses: DataFrame, calendar: DataFrame, last: Column | None = None
) -> DataFrame:
    """Add each day's latest finished pause and next coming pause.

    ``state``: one row per subscription and day (``admin_user_id``, ``protocol``,
    ``date_day``, ``start_date_pst``, ``next_start_date_pst``). ``pauses``:
    ``admin_user_id``, ``protocol``, ``paused_at``, ``paused_date_pst``,
    ``resumed_date_pst``, ``created_dt_pst``.

    Past: inside the subscription, known on the day, and over before the next
    subscription starts or, for an open one, by the day itself. Future: known on
    the day and starting after it. Days are never paired with all pauses of a
    user: a past pause becomes one mark on the first day it counts from and a
    running maximum carries it on; a coming pause is expanded to the days on
    which it is ahead and reduced to the earliest per day.
    """
    owner = ["admin_user_id", "protocol"]
    values = ["paused_at", "paused_date_pst", "resumed_date_pst"]
    known = pauses.filter(F.col("paused_date_pst").isNotNull() & F.col("created_dt_pst").isNotNull())

    finished = (
        known.filter(F.col("resumed_date_pst").isNotNull())
        .groupBy(*owner, "paused_date_pst", "resumed_date_pst", "created_dt_pst")
        .agg(F.max("paused_at").alias("paused_at"))
    )
    term = [*owner, "start_date_pst", "next_start_date_pst"]
    closed_in_time = F.col("next_start_date_pst").isNull() | (
        F.col("resumed_date_pst") < F.col("next_start_date_pst")
    )
    counts_from = F.greatest(
        "created_dt_pst",
        "start_date_pst",
        F.when(F.col("next_start_date_pst").isNull(), F.col("resumed_date_pst")),
    )
    # Terms and pauses meet by month and not by user alone, so that a user with very
    # many of both is split: a term that a pause lies in shares the month of its
    # beginning (or, if it ends before it begins, one of the months between). A
    # pair found twice does no harm to a maximum.
    month = F.expr("INTERVAL 1 MONTH")
    ends = F.greatest(F.col("start_date_pst"), F.coalesce("next_start_date_pst", "_last"))
    terms = (
        state.groupBy(*term)
        .agg(F.max("date_day").alias("_last"))
        .withColumn(
            "_month",
            F.explode(F.sequence(F.trunc("start_date_pst", "month"), F.trunc(ends, "month"), month)),
        )
        .drop("_last")
    )
    begins = F.trunc(F.least("paused_date_pst", "resumed_date_pst"), "month")
    by_month = finished.withColumn(
        "_month", F.explode(F.sequence(begins, F.trunc("paused_date_pst", "month"), month))
    )
    marks = (
        terms.join(by_month, [*owner, "_month"])
        .filter((F.col("paused_date_pst") >= F.col("start_date_pst")) & closed_in_time)
        .groupBy(*term, counts_from.alias("date_day"))
        .agg(F.max(F.struct(*values)).alias("_mark"))
    )
    so_far = (
        Window.partitionBy(*term)
        .orderBy("date_day", F.col("_is_state"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    with_past = (
        state.withColumn("_is_state", F.lit(True))
        .unionByName(marks.withColumn("_is_state", F.lit(False)), allowMissingColumns=True)
        .withColumn("_past", F.max("_mark").over(so_far))
        .filter("_is_state")
        .drop("_is_state", "_mark")
    )

    ahead = known.withColumn("_until", F.least("paused_date_pst", "resumed_date_pst"))
    ahead = ahead.groupBy(*owner, "created_dt_pst", "_until").agg(F.min(F.struct(*values)).alias("_coming"))
    coming = (
        expand_days(ahead, "created_dt_pst", ["_until"], calendar, day="date_day", last=last)
        .groupBy(*owner, "date_day")
        .agg(F.min("_coming").alias("_coming"))
    )
    return (
        with_past.join(coming, [*owner, "date_day"], "left")
        .withColumn("past_paused_at", F.col("_past.paused_at"))
        .withColumn("past_pause", F.col("past_paused_at").isNotNull())
        .withColumn("past_pause_at", F.col("_past.paused_date_pst"))
        .withColumn("past_resume_at", F.col("_past.resumed_date_pst"))
        .withColumn("future_paused_at", F.col("_coming.paused_at"))
        .withColumn("future_pause", F.col("future_paused_at").isNotNull())
        .withColumn("future_pause_at", F.col("_coming.paused_date_pst"))
        .withColumn("future_resume_at", F.col("_coming.resumed_date_pst"))
        .drop("_past", "_coming")
    )

"""Cancel and uncancel events to intervals, and intervals to daily state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exists, local_date, local_datetime
from tidemark.operators.intervals import expand_days

# Event names, the reasons that mark a system-made cancellation,
# the final order of the daily table, the start of the first interval and the zone of the
# business day.
CANCELLED = "Values::Events::AccountCancelled"
UNCANCELLED = "Values::Events::AccountUncancelled"
SYSTEM_REASONS = ("Inactive System Cancel", "30+ days of billing issue")
CANCEL_DAILY_ORDER = ("admin_user_id", "protocol", "cancelled_at", "day_date")
FIRST_VALID_FROM = "1900-01-01 00:00:00"
BUSINESS_ZONE = "America/Los_Angeles"


def by_day() -> Column:
    """The default cut of the event order."""
    return F.to_date("created_at")


#: The order of events within a user and product, and what a cancellation still has to carry.
_KEYS, _ORDER = ("admin_user_id", "product_name"), ("created_at", "version")
_DETAILS = ("cancelled_at", "operator_type", "operator_id", "system_cancellation_reason", "cancel_immediately")


def _in_force(cancelled_at: Column, end: Column) -> Column:
    """False for a cancellation that was taken back before its date."""
    return F.coalesce(cancelled_at < end, F.lit(True))


def _run_ends(events: DataFrame, segment: Column) -> DataFrame:
    """Inside each segment, the row that stands for each run of equal events.

    From a run the newest ``created_at`` is kept, on a tie the lowest ``version``: the first
    row of the run's last stretch of equal times. Adds what follows it inside the segment.
    """
    group = Window.partitionBy("_group").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    kept = events.filter(F.col("event_type").isin(CANCELLED, UNCANCELLED) & F.col("product_name").isNotNull())
    # One struct as key, so that null users form a group as they do in a window.
    # The details travel as one column: both readers of the rows then need the same columns and share their shuffle.
    rows = kept.select(F.struct(*_KEYS, segment.alias("segment")).alias("_group"), "event_type", *_ORDER, F.struct(*_DETAILS).alias("_details"))
    before = F.lag(F.struct("event_type", "created_at")).over(group)
    heads = rows.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.struct("event_type", "created_at")))
    ends = heads.withColumn("_type_after", F.lead("event_type").over(group)).filter(
        ~F.col("_type_after").eqNullSafe(F.col("event_type"))
    )
    return ends.select(
        "_group", "event_type", *_ORDER, "_details",
        F.lead(F.struct("created_at")).over(group).alias("_next"),
        F.lead(F.lit(True), 2).over(group).isNotNull().alias("_settled"),
    ).withColumn("_stands", F.col("_settled") & _in_force(F.col("_details.cancelled_at"), F.col("_next.created_at")))


def _carried(ends: DataFrame) -> DataFrame:
    """One row per segment with all that its rows need to know from other segments.

    A segment is a transition between runs. Its first run may go on from earlier segments and
    its last into later ones, so three things are open at its borders: when the run ends that
    the next event belongs to, whether the segment's last cancellation stands, and which
    standing cancellations come before and after. They are carried along the segments of a
    user and product in one ordering of these summaries.
    """
    cancel = F.col("event_type") == CANCELLED
    place = F.struct(*_ORDER)
    whole = F.struct(*_ORDER, "_details", "_next")
    summary = ends.groupBy("_group").agg(
        F.min_by("event_type", place).alias("first_type"),
        F.min(F.struct(*_ORDER)).alias("first_end"),
        F.max_by("event_type", place).alias("last_type"),
        (F.count(F.lit(1)) > 1).alias("mixed"),
        # The last cancellation, if it is the last or the last but one of the segment's runs.
        F.max(F.when(cancel & ~F.col("_settled"), whole)).alias("open"),
        F.min(F.when(cancel & F.col("_stands"), F.struct(*_ORDER))).alias("first_standing"),
        F.max(F.when(cancel & F.col("_stands"), F.struct(*_ORDER, F.col("_next.created_at").alias("end")))).alias("last_standing"),
    )
    # As columns of their own, so that all windows below are seen to share one shuffle.
    summary = summary.select("*", *[F.col("_group")[k].alias(k) for k in _KEYS], F.col("_group.segment").alias("segment"))
    backwards = Window.partitionBy(*_KEYS).orderBy(F.col("segment").desc_nulls_last())
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*_KEYS).orderBy(F.col("segment").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)

    # ``first_end`` ends the segment's first run, unless the whole segment is of that type and the next one goes on with it.
    summary = summary.withColumn("type_after", F.lag("first_type").over(backwards))
    ended = F.col("mixed") | ~F.col("type_after").eqNullSafe(F.col("first_type"))
    summary = summary.withColumn("run_end", F.when(ended, F.struct(F.col("first_end.created_at").alias("at"))))
    summary = summary.withColumn("end_after", F.last("run_end", ignorenulls=True).over(later))

    last_ends = ~F.col("type_after").eqNullSafe(F.col("last_type"))
    is_last = F.col("last_type") == CANCELLED
    inside = ~is_last & last_ends  # the run after the open cancellation ends in this segment
    open_end = F.when(inside, F.col("open._next.created_at")).otherwise(F.col("end_after.at"))
    stands = F.col("open").isNotNull() & (~is_last | last_ends) & _in_force(F.col("open._details.cancelled_at"), open_end)
    summary = summary.select(
        "_group", *_KEYS, "segment", "first_standing", "last_standing", "open",
        stands.alias("open_stands"),
        open_end.alias("open_end"),
    )
    first = F.coalesce(F.col("first_standing.created_at"), F.col("open.created_at"))
    last = F.when(F.col("open_stands"), F.col("open_end")).otherwise(F.col("last_standing.end"))
    has_any = F.col("open_stands") | F.col("first_standing").isNotNull()
    summary = summary.withColumn("first_at", F.when(has_any, F.struct(first.alias("created_at"))))
    summary = summary.withColumn("last_end", F.when(has_any, F.struct(last.alias("end"))))
    return summary.select(
        "_group",
        "open_stands",
        "open_end",
        F.last("first_at", ignorenulls=True).over(later).alias("standing_after"),
        F.last("last_end", ignorenulls=True).over(earlier).alias("standing_before"),
    )


def standing_cancellations(events: DataFrame, segment: Column | None = None) -> DataFrame:
    """Cancellations that came into force, with their end and their neighbours.

    Runs of equal events are reduced to one (see ``_run_ends``), so that events alternate; the
    event after a cancellation ends it, and one that was ended before its date is dropped.
    Adds ``uncancelled_at``, ``previous`` (its end, null for the first) and ``following`` (its
    creation, null for the last), both as structs.

    The events of a user and product are cut by ``segment``, a column of ``created_at`` that
    does not decrease with it: by default days, or finer, e.g. hours. The events are shuffled
    once; the largest sort is a segment, or the segments' summaries of one user and product.
    """
    ends = _run_ends(events, by_day() if segment is None else segment)
    joined = ends.filter(F.col("event_type") == CANCELLED).join(_carried(ends), "_group")
    standing = joined.filter(F.when(F.col("_settled"), F.col("_stands")).otherwise(F.col("open_stands"))).withColumn(
        "uncancelled_at", F.when(F.col("_settled"), F.col("_next.created_at")).otherwise(F.col("open_end"))
    )
    group = Window.partitionBy("_group").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    previous = F.lag(F.struct(F.col("uncancelled_at").alias("end"))).over(group)
    following = F.lead(F.struct("created_at")).over(group)
    return standing.select(
        *[F.col("_group")[k].alias(k) for k in _KEYS], *_ORDER, "_details.*", "uncancelled_at",
        F.coalesce(previous, "standing_before").alias("previous"),
        F.coalesce(following, "standing_after").alias("following"),
    )


def cancellation_timeline(
    events: DataFrame, products: DataFrame, segment: Column | None = None
) -> DataFrame:
    """One row per effective cancellation with the interval it was in force.

    ``segment`` as in ``standing_cancellations``. One plan for all sizes; nothing runs
    before the result is asked for.
    """
    placed = standing_cancellations(events, segment).withColumns(
        {"_previous_end": F.col("previous.end"), "next_cancellation_created_at": F.col("following.created_at")}
    )
    is_first = F.col("previous").isNull()
    given_date_holds = (F.col("cancelled_at") > F.col("_previous_end")) | (
        F.col("_previous_end").isNull() & is_first & F.col("cancelled_at").isNotNull()
    )
    dated = placed.select(
        "admin_user_id",
        "product_name",
        F.col("created_at").alias("cancellation_created_at"),
        "next_cancellation_created_at",
        "operator_type",
        "operator_id",
        "system_cancellation_reason",
        "cancel_immediately",
        F.coalesce(
            "_previous_end", F.when(is_first, F.lit(FIRST_VALID_FROM).cast("timestamp"))
        ).alias("valid_from"),
        F.coalesce(F.when(given_date_holds, F.col("cancelled_at")), F.col("created_at")).alias("cancelled_at"),
        "uncancelled_at",
    )
    local = {
        "cancellation_created_at_dt_pst": "cancellation_created_at",
        "next_cancellation_created_at_dt_pst": "next_cancellation_created_at",
        "cancelled_at_dt_pst": "cancelled_at",
        "uncancelled_at_dt_pst": "uncancelled_at",
    }
    return (
        dated.join(products.select("product_name", "protocol"), "product_name", "left")
        .withColumns({name: local_date(F.col(src), BUSINESS_ZONE) for name, src in local.items()})
        .withColumn("cancelled_at_dt_utc", F.to_date("cancelled_at"))
        .withColumn("uncancelled_at_dt_utc", F.to_date("uncancelled_at"))
        .withColumn("cancelled_at_pst", local_datetime(F.col("cancelled_at"), BUSINESS_ZONE))
    )


def is_system_cancel(reason: str) -> Column:
    """1 when the reason is one of the system-made ones, else 0."""
    return F.when(F.col(reason).isin(*SYSTEM_REASONS), 1).otherwise(0)


def cancel_daily(timeline: DataFrame, calendar: DataFrame, products: DataFrame, contiguous: bool = False) -> DataFrame:
    """Daily view of cancellations in force and of those announced for later.

    Both expansions read ``timeline``; hand in a written table (or one passed
    through ``cut_lineage``). ``contiguous`` as in ``expand_days``.
    """
    keys = ["day_date", "admin_user_id", "product_name"]
    announced = expand_days(
        timeline.filter(F.col("cancelled_at_dt_pst").isNotNull()),
        "cancellation_created_at_dt_pst",
        ["cancelled_at_dt_pst", "next_cancellation_created_at_dt_pst"],
        calendar,
        contiguous=contiguous,
    ).select(
        *keys,
        F.col("cancellation_created_at").alias("future_cancel_created_at"),
        F.col("cancellation_created_at_dt_pst").alias("future_cancel_created_dt_pst"),
        F.col("cancelled_at").alias("future_cancel_scheduled_for"),
        F.col("uncancelled_at").alias("future_cancel_scheduled_to_end"),
        F.col("system_cancellation_reason").alias("future_cancel_system_cancellation_reason"),
        F.col("cancelled_at_dt_pst").alias("future_cancel_scheduled_for_dt_pst"),
        is_system_cancel("system_cancellation_reason").alias("future_cancel_is_autocancel"),
    )
    in_force = expand_days(timeline, "cancelled_at_dt_pst", ["uncancelled_at_dt_pst"], calendar, contiguous=contiguous).select(
        *keys,
        "cancellation_created_at",
        "system_cancellation_reason",
        "cancelled_at",
        "uncancelled_at",
        "cancelled_at_pst",
        "cancelled_at_dt_pst",
        "uncancelled_at_dt_pst",
        "cancellation_created_at_dt_pst",
    )
    return (
        in_force.join(announced, keys, "full")
        .join(products.select("product_name", "protocol"), "product_name", "left")
        .withColumn("is_autocancel", is_system_cancel("system_cancellation_reason"))
        .withColumn("actively_cancelled", exists(F.col("cancelled_at").isNotNull()))
        .withColumn("cancelled_in_future", exists(F.col("future_cancel_scheduled_for").isNotNull()))
    )

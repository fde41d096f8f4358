"""Length of the current run of consecutive periods in one status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequences import with_neighbours, with_running


def status_streaks(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    status: str,
    step_days: int = 7,
    segment: Column | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Number each snapshot within its run of unbroken periods in one status.

    A run ends when a period is skipped or the status changes; a change from or
    to a null status is unknown and ends nothing. Snapshots are expected once per
    (key, period). Inside a run every row is exactly one step after the row
    before it, so its number follows from the date on which the run began and no
    window over the run itself is needed.

    With one row per (key, period) a window holds at most as many rows as the
    calendar has periods. ``segment`` (for example the year of the period) splits
    it further for inputs without that guarantee.
    """
    label = {
        "previous_period": f"previous_{period}",
        "previous_status": f"previous_{status}",
        "period_group": "week_grp",
        "status_group": f"{status}_grp",
        "streak": "consecutive_weeks_in_status",
        **(names or {}),
    }
    looked_back = with_neighbours(
        df, keys, [period], segment,
        lags={label["previous_period"]: period, label["previous_status"]: status},
    )
    skipped = F.col(period) != F.date_add(label["previous_period"], step_days)
    changed = F.col(status) != F.col(label["previous_status"])
    flagged = (
        looked_back.withColumn("has_date_gap_flag", F.when(skipped, 1))
        .withColumn("has_different_status_flag", F.when(changed, 1))
    )
    begins = (
        F.col(label["previous_period"]).isNull()
        | F.col("has_date_gap_flag").isNotNull()
        | F.col("has_different_status_flag").isNotNull()
    )
    grouped = with_running(
        flagged, keys, [period], segment,
        {
            label["period_group"]: ("sum", F.col("has_date_gap_flag")),
            label["status_group"]: ("sum", F.col("has_different_status_flag")),
            "_run_start": ("max", F.when(begins, F.col(period))),
        },
    )
    streak = (F.datediff(period, "_run_start") / F.lit(step_days)).cast("bigint") + 1
    return grouped.withColumn(label["streak"], streak).drop("_run_start")

"""Ordered look-back, look-ahead and running totals that survive hot keys.

A plain ``lag(..).over(partitionBy(key))`` sorts all rows of a key in one task.
Here the order is cut into segments (for example days) that grow with it, the
window runs per (key, segment), and only one summary row per segment is ordered
by key to carry values over the segment borders. The result equals the plain
window; the largest sort is one segment instead of one key.

``segment`` must not decrease along ``order``. Orders are ascending with nulls
first and must be total within a key. With ``segment=None`` the plain window is
used; that is for callers whose keys are bounded by what they are, such as one
row per week.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP = "_segment_key"
_SEGMENT = "_segment"


def _cut(df: DataFrame, keys: Sequence[str], segment: Column) -> DataFrame:
    # One struct as key: equality on it treats null parts as equal, so that null
    # keys form a group as they do in a window, and the window and the join
    # below share one hash partitioning.
    return df.withColumn(_SEGMENT, segment).withColumn(_GROUP, F.struct(*keys, F.col(_SEGMENT)))


def _along(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def _across(keys: Sequence[str]):
    owner = [F.col(_GROUP)[k] for k in keys]
    return Window.partitionBy(*owner).orderBy(F.col(_GROUP)[_SEGMENT].asc_nulls_first())


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | None,
    lags: Mapping[str, str] | None = None,
    leads: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add values of the previous (``lags``) and next (``leads``) row.

    Both map a new column name to the column it is read from.
    """
    lags, leads = dict(lags or {}), dict(leads or {})
    if segment is None:
        plain = Window.partitionBy(*keys).orderBy(*_along(order))
        return df.select(
            "*",
            *[F.lag(src).over(plain).alias(new) for new, src in lags.items()],
            *[F.lead(src).over(plain).alias(new) for new, src in leads.items()],
        )
    cut = _cut(df, keys, segment)
    place = F.struct(*order)
    inside = Window.partitionBy(_GROUP).orderBy(*_along(order))

    borders, carried, local, result = [], [], [], []
    if lags:
        values = F.struct(*[F.col(src).alias(new) for new, src in lags.items()])
        borders.append(F.max_by(values, place).alias("_last"))
        carried.append(F.lag("_last").over(_across(keys)).alias("_before"))
        local.append(F.lag(values).over(inside).alias("_previous"))
        result.append(F.coalesce("_previous", "_before").alias("_previous"))
    if leads:
        values = F.struct(*[F.col(src).alias(new) for new, src in leads.items()])
        borders.append(F.min_by(values, place).alias("_first"))
        carried.append(F.lead("_first").over(_across(keys)).alias("_after"))
        local.append(F.lead(values).over(inside).alias("_next"))
        result.append(F.coalesce("_next", "_after").alias("_next"))

    summary = cut.groupBy(_GROUP).agg(*borders).select(_GROUP, *carried)
    joined = cut.select("*", *local).join(summary, _GROUP)
    return joined.select(*df.columns, *result).select(
        *df.columns,
        *[F.col("_previous")[new].alias(new) for new in lags],
        *[F.col("_next")[new].alias(new) for new in leads],
    )


_TOTALS = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _merge(kind: str, before: Column, here: Column) -> Column:
    if kind == "count":
        return F.coalesce(before, F.lit(0)) + here
    if kind == "sum":
        return F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))
    return (F.greatest if kind == "max" else F.least)(before, here)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | None,
    totals: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add running totals up to and including the row.

    ``totals`` maps a name to (``sum`` | ``count`` | ``max`` | ``min``, column).
    """
    if segment is None:
        plain = Window.partitionBy(*keys).orderBy(*_along(order))
        plain = plain.rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[_TOTALS[k](c).over(plain).alias(n) for n, (k, c) in totals.items()])
    cut = _cut(df, keys, segment)
    inside = Window.partitionBy(_GROUP).orderBy(*_along(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)

    # A running count of a segment's counts is a sum; the others fold with themselves.
    summary = cut.groupBy(_GROUP).agg(*[_TOTALS[k](c).alias(n) for n, (k, c) in totals.items()])
    summary = summary.select(
        _GROUP,
        *[
            _TOTALS["sum" if k == "count" else k](n).over(before).alias(f"_before_{n}")
            for n, (k, _) in totals.items()
        ],
    )
    local = [_TOTALS[k](c).over(inside).alias(f"_here_{n}") for n, (k, c) in totals.items()]
    joined = cut.select("*", *local).join(summary, _GROUP)
    return joined.select(
        *df.columns,
        *[_merge(k, F.col(f"_before_{n}"), F.col(f"_here_{n}")).alias(n) for n, (k, _) in totals.items()],
    )

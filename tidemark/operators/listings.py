"""Daily listing snapshots: cleaning, standard names, changes, days on market."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    capitalise_words,
    exists,
    first_group,
    number_or_null,
    try_decimal,
    try_double,
)
from tidemark.operators.keys import latest_per_key, left_join

# Statuses of a listing that is no longer for sale, the statuses a
# sale moves to and a cancellation returns to, and the first trusted report date.
OFF_MARKET = ("Under Contract", "Closed")
SOLD = "Under Contract"
FOR_SALE = "Now Selling"
FIRST_REPORT_DATE = dt.date(2024, 10, 14)
# Fixed value: the fields read from a listing's document, as text.
HOUSE = "bed string, bath string, garage string, story string, sqft string"


def _by_day() -> Window:
    return Window.partitionBy("homesite_id").orderBy(F.col("report_date").asc_nulls_first())


def _whole() -> Window:
    return _by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _so_far() -> Window:
    """All rows up to the day, that is with every copy of the day's own row."""
    return _by_day().rangeBetween(Window.unboundedPreceding, 0)


def city_state_zip(address: str) -> dict[str, Column]:
    """City, state and zip from ``City ST, 12345`` or ``City, ST 12345``.

    Six characters after the first comma (a space and a zip code) mean that the
    state stands before it.
    """
    text = F.col(address)
    comma = F.locate(",", text)
    comma_space = F.locate(", ", text)
    tail = text.substr(comma + 1, F.length(text))
    state_first = F.length(tail) == 6
    head = text.substr(F.lit(1), F.greatest(comma - 1, F.lit(0)))
    return {
        "city": F.initcap(
            F.when(~state_first, head).otherwise(F.trim(first_group(text, "^(.*) [A-Z]{2},")))
        ),
        "state": F.when(state_first, text.substr(comma - 2, F.lit(2))).otherwise(
            text.substr(comma_space + 2, F.lit(2))
        ),
        "zip_code": F.regexp_substr(tail, F.lit(r"\d+$")),
    }


def plan_name(plan: str) -> Column:
    """Word-cased plan name with roman two, however it was typed."""
    cased = capitalise_words(F.col(plan))
    return F.replace(F.replace(cased, F.lit(" Ii"), F.lit(" II")), F.lit(" ||"), F.lit(" II"))


def clean_listings(
    listings: DataFrame, min_date: dt.date = FIRST_REPORT_DATE, tie_break: Sequence[Column] = ()
) -> DataFrame:
    """One clean row per homesite and report date.

    The date floor is set on the raw run date so that it reaches the scan. Rows
    are reduced to one per (homesite, date) first; from there on a window over a
    homesite holds at most one row per day of the calendar.
    """
    in_scope = listings.filter(F.col("run_date") >= F.lit(min_date + dt.timedelta(days=1)))
    first_report = in_scope.agg(F.date_add(F.min("run_date"), -1)).scalar()

    price_is_status = ~F.replace(F.col("price"), F.lit("."), F.lit("")).rlike("^[0-9]+$")
    base = (
        in_scope.withColumn("report_date", F.date_add("run_date", -1))
        .withColumn("status", F.coalesce("status", F.when(price_is_status, F.col("price"))))
        .withColumn("price", try_double(F.col("price")))
        .withColumn("floor_plan", plan_name("floor_plan"))
        .withColumn("city_address", F.replace("city_address", F.lit("Saint "), F.lit("St. ")))
        .drop("run_date")
    )
    daily = latest_per_key(
        base, ["homesite_id", "report_date"], [F.col("prefect_uploaded_at").desc_nulls_first(), *tie_break]
    )

    def trait(name: str, parse) -> Column:
        return F.last(parse(F.col("_house")[name])).over(_whole())

    on_offer = F.when(~F.col("status").isin(*OFF_MARKET), F.col("report_date"))
    return (
        daily.withColumns(city_state_zip("city_address"))
        .withColumn("_house", F.from_json("house_info", HOUSE))
        .withColumns(
            {
                "bed": trait("bed", try_decimal),
                "bath": trait("bath", try_decimal),
                "garage": trait("garage", try_decimal),
                "story": trait("story", number_or_null),
                "sqft": trait("sqft", number_or_null),
                "first_seen_avail_dt": F.min(on_offer).over(_so_far()),
                "last_seen_avail_dt": F.max(on_offer).over(_whole()),
                "previous_report_date": F.lag("report_date").over(_by_day()),
            }
        )
        .withColumn("daily_homesite_key", F.md5(F.concat(F.col("report_date").cast("string"), "homesite_id")))
        .withColumn("min_report_dt", first_report)
        .drop("house_info", "_house")
    )


def standardise_dims(clean: DataFrame, map_community: DataFrame, map_plan: DataFrame) -> DataFrame:
    """Replace community and plan by their mapped values; unmapped ones become null."""
    communities = map_community.select("community_id", "rpt_community_id", "rpt_community_name")
    plans = map_plan.select(
        F.col("community_id").alias("rpt_community_id"), "floor_plan", "bed", "bath", "rpt_floor_plan"
    )
    return (
        clean.drop("community_name")
        .join(communities, "community_id", "left")
        .drop("community_id")
        .transform(
            lambda named: left_join(
                named, plans, ["rpt_community_id", "floor_plan", "bed", "bath"], ["homesite_id", "report_date"]
            )
        )
        .drop("floor_plan")
        .withColumnsRenamed(
            {
                "rpt_community_id": "community_id",
                "rpt_community_name": "community_name",
                "rpt_floor_plan": "floor_plan",
            }
        )
    )


def snapshot_changes(listings: DataFrame, communities: DataFrame) -> DataFrame:
    """Compare each snapshot with the homesite's one before; sale and cancel flags.

    A plan that stands in several chains gives several rows per homesite and day.
    Each of a day's rows meets each of the previous report day's, so the result
    has their product. The rows are dealt by homesite once; a homesite's day becomes
    one row that holds them all, takes over what it compares with from the day before
    and gives its rows back. The listings are read once.
    """
    latest = latest_per_key(
        communities, ["community_id"], [F.col("report_date").desc_nulls_first(), F.col("area_name")]
    ).select("community_id", "area_name", F.col("first_seen_avail_dt").alias("comm_first_seen_avail_dt"))

    status, before = F.col("status"), F.col("status_previous_report_dt")
    known_before = F.col("previous_report_date").isNotNull()
    sale = known_before & ~before.isin(*OFF_MARKET) & (status == SOLD)
    cancel = known_before & before.isin(*OFF_MARKET) & (status == FOR_SALE)
    took_effect = known_before & (F.coalesce(before, F.lit("")) == "") & (status == SOLD)
    until = F.when(status.isin(*OFF_MARKET), F.col("latest_sale_dt")).otherwise(F.col("report_date"))
    named = left_join(listings, latest, ["community_id"], ["homesite_id", "report_date"])
    day = ["homesite_id", "report_date"]
    compared = F.transform(
        "_rows",
        lambda r: F.struct(r["price"].alias("price_previous_report_dt"), r["status"].alias("status_previous_report_dt")),
    )
    # Dealt by homesite, the days below are groups and windows of one shuffle.
    days = named.repartition("homesite_id").groupBy(*day).agg(
        F.collect_list(F.struct(*[c for c in named.columns if c not in day])).alias("_rows")
    )
    carried = F.when(F.col("homesite_id").isNotNull(), F.lag("_compared").over(_by_day()))
    paired = (
        days.withColumn("_compared", compared)
        .withColumn("_previous", carried)
        .select(*day, "_previous", F.explode("_rows").alias("_row"))
        .select(*day, "_previous", "_row.*")
        .select(*named.columns, F.explode_outer("_previous").alias("_before"))
    )
    return (
        paired
        .withColumns(
            {
                "price_previous_report_dt": F.col("_before.price_previous_report_dt"),
                "status_previous_report_dt": F.col("_before.status_previous_report_dt"),
                "earliest_price": F.first("price", ignorenulls=True).over(_whole()),
            }
        )
        .drop("_before")
        .withColumn("sale_flag", exists(sale))
        .withColumn("cancel_flag", exists(cancel))
        .withColumns(
            {
                "latest_sale_dt": F.max(F.when(F.col("sale_flag"), F.col("report_date"))).over(_so_far()),
                "latest_cancel_dt": F.max(F.when(F.col("cancel_flag"), F.col("report_date"))).over(_so_far()),
            }
        )
        .withColumn("price_chg_dod", F.col("price") - F.col("price_previous_report_dt"))
        .withColumn(
            "price", F.when(took_effect, F.col("price_previous_report_dt")).otherwise(F.col("price"))
        )
        .withColumn("days_since_first_listed", F.datediff(until, "first_seen_avail_dt"))
        .withColumn("first_seen_avail_flag", exists(F.col("first_seen_avail_dt") == F.col("report_date")))
        .withColumn("last_seen_avail_flag", exists(F.col("last_seen_avail_dt") == F.col("report_date")))
    )


def days_on_market(changes: DataFrame) -> DataFrame:
    """Days a homesite has been for sale, restarted by a cancelled sale."""
    first, sale, cancel = (F.col(c) for c in ("first_seen_avail_dt", "latest_sale_dt", "latest_cancel_dt"))
    there_from_start = (first == F.col("comm_first_seen_avail_dt")) & (
        F.col("comm_first_seen_avail_dt") == F.col("min_report_dt")
    )
    sold, cancelled = F.col("sale_count") > 0, F.col("cancel_count") > 0
    off_market = F.col("status").isin(*OFF_MARKET)
    days = (
        F.when(there_from_start, F.lit(None).cast("int"))
        .when(~cancelled & sold, F.datediff(sale, first))
        .when(cancelled & sold & off_market, F.datediff(sale, cancel))
        .when(cancelled & sold & ~off_market, F.datediff("report_date", cancel))
        .otherwise(F.datediff("report_date", first))
    )
    return changes.withColumns(
        {
            "sale_count": F.count(F.when(F.col("sale_flag"), F.col("latest_sale_dt"))).over(_so_far()),
            "cancel_count": F.count(F.when(F.col("cancel_flag"), F.col("latest_cancel_dt"))).over(_so_far()),
        }
    ).withColumn("days_on_market", days)


# The columns of the reporting table.
REPORT_COLUMNS = (
    "daily_homesite_key",
    "report_date",
    "company",
    "area_name",
    "homesite_id",
    "community_id",
    "community_name",
    "street_address",
    "city",
    "state",
    "zip_code",
    "floor_plan",
    "bed",
    "bath",
    "garage",
    "sqft",
    "story",
    "price",
    "price_previous_report_dt",
    "price_chg_dod",
    "earliest_price",
    "status",
    "status_previous_report_dt",
    "days_since_first_listed",
    "days_on_market",
    "first_seen_avail_dt",
    "last_seen_avail_dt",
    "latest_sale_dt",
    "latest_cancel_dt",
    "first_seen_avail_flag",
    "last_seen_avail_flag",
    "sale_flag",
    "cancel_flag",
    "prefect_uploaded_at",
)


def listing_report(
    listings: DataFrame,
    communities: DataFrame,
    map_community: DataFrame,
    map_plan: DataFrame,
    min_date: dt.date = FIRST_REPORT_DATE,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Raw snapshots to the reporting table."""
    clean = clean_listings(listings, min_date, tie_break)
    named = standardise_dims(clean, map_community, map_plan)
    return days_on_market(snapshot_changes(named, communities)).select(*REPORT_COLUMNS)

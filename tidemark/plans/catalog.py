"""Registered queries: every operator over whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import chains, listings, requests, scoring, subscriptions
from tidemark.operators.cancellations import CANCEL_DAILY_ORDER, cancel_daily, cancellation_timeline
from tidemark.operators.intervals import expand_days, nearest_pauses, point_in_time_join
from tidemark.operators.keys import latest_per_key
from tidemark.operators.streaks import status_streaks
from tidemark.plans import bindings as b
from tidemark.session import checkpoint_dir, cut_lineage
from tidemark.sources.bundles import FLAT_SCHEMA, flatten_bundles, load_flat, read_bundles
from tidemark.sources.tables import landing, read_numbered, write_ordered
from tidemark.sources.upsert import KeyedTable, high_water_mark, newer_than_target, run_record, sync, upsert
from tidemark.streaming.bundles import bundle_stream, stream_into

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Types every engine shares: whole numbers as bigint, decimals as double, lists as text."""

    def shared(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column, ",").alias(field.name)
        return column

    return df.select(*[shared(f) for f in df.schema.fields])


# --- streaks -------------------------------------------------------------------


def q_status_streaks(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["distribution_center", "product_id"]
    return plain(status_streaks(b.inventory(spark, folder), keys, "report_week", "availability_status"))


# --- chains --------------------------------------------------------------------

_SITE = {"group": "community_id", "traits": ["bed", "bath"]}


def _lists(spark: SparkSession, folder: str) -> DataFrame:
    return chains.value_lists(
        b.homesites(spark, folder), "homesite_id", value="floor_plan", date="report_date", **_SITE
    )


def q_value_lists(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_lists(spark, folder))


def q_chain_sequential(spark: SparkSession, folder: str) -> DataFrame:
    return plain(chains.chain_lists_sequential(_lists(spark, folder), **_SITE).drop("list_id"))


def q_merge_transitive(spark: SparkSession, folder: str) -> DataFrame:
    chained = cut_lineage(chains.chain_lists_sequential(_lists(spark, folder), **_SITE))
    return plain(chains.merge_lists_transitive(chained, **_SITE))


def _canonical(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return chains.canonicalise(
        b.homesites(spark, folder), "homesite_id", value="floor_plan", date="report_date", **_SITE
    )


def q_canonical_map(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_canonical(spark, folder)[0])


def q_canonical_values(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_canonical(spark, folder)[1])


# --- listings ------------------------------------------------------------------


def _tie() -> list[Column]:
    return [F.col("load_order").desc()]


def q_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    newest = latest_per_key(
        b.listings(spark, folder),
        ["homesite_id", "run_date"],
        [F.col("prefect_uploaded_at").desc_nulls_first(), *_tie()],
    )
    return plain(newest)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return listings.clean_listings(b.listings(spark, folder), b.LISTING_FLOOR, _tie())


def q_listing_clean(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_clean(spark, folder))


def _named(spark: SparkSession, folder: str) -> DataFrame:
    clean = _clean(spark, folder)
    communities = b.community_map(spark, folder)
    return listings.standardise_dims(clean, communities, b.plan_map(clean, communities))


def q_listing_dims(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["homesite_id", "report_date", "community_id", "community_name", "floor_plan", "bed", "bath"]
    return plain(_named(spark, folder).select(*columns))


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return listings.snapshot_changes(_named(spark, folder), b.communities(spark, folder))


def q_listing_changes(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_changes(spark, folder).select(*b.CHANGE_COLUMNS))


def q_days_on_market(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["homesite_id", "report_date", "sale_count", "cancel_count", "days_on_market"]
    return plain(listings.days_on_market(_changes(spark, folder)).select(*columns))


def q_listing_report(spark: SparkSession, folder: str) -> DataFrame:
    return plain(listings.days_on_market(_changes(spark, folder)).select(*listings.REPORT_COLUMNS))


def q_listing_from_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Plan names by chaining the listings' own value lists, then the report under these names."""
    raw, communities = b.listings(spark, folder), b.community_map(spark, folder)
    seen = listings.clean_listings(raw, b.LISTING_FLOOR, _tie()).join(communities, "community_id")
    named, _ = chains.canonicalise(
        seen.filter(F.col("rpt_community_id").isNotNull()),
        "homesite_id", "rpt_community_id", "floor_plan", "report_date", ["bed", "bath"],
    )
    plans = named.withColumnRenamed("rpt_community_id", "community_id")
    report = listings.listing_report(raw, b.communities(spark, folder), communities, plans, b.LISTING_FLOOR, _tie())
    return plain(report)


# --- cancellations -------------------------------------------------------------


def _timeline(spark: SparkSession, folder: str, products: DataFrame | None = None) -> DataFrame:
    return cancellation_timeline(b.cancel_events(spark, folder), b.products(spark, folder) if products is None else products)


def q_cancel_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_timeline(spark, folder))


def q_interval_days(spark: SparkSession, folder: str) -> DataFrame:
    days = expand_days(
        _timeline(spark, folder), "cancelled_at_dt_pst", ["uncancelled_at_dt_pst"], b.event_calendar(spark, folder),
        contiguous=True,
    )
    return plain(days.select("admin_user_id", "product_name", "day_date", "cancelled_at", "uncancelled_at"))


def _cancel_days(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    products = b.products(spark, folder)
    return cancel_daily(cut_lineage(_timeline(spark, folder, products)), calendar, products, contiguous=True)


def q_cancel_daily(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_cancel_days(spark, folder, b.event_calendar(spark, folder)))


# --- subscriptions -------------------------------------------------------------


def _state(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    return subscriptions.subscription_daily(
        b.subscriptions(spark, folder),
        b.pause_days(spark, folder, calendar),
        _cancel_days(spark, folder, calendar),
        b.billing_days(spark, folder, calendar),
        b.renewal_days(spark, folder, calendar),
        b.order_days(spark, folder, calendar),
        calendar,
        b.last_business_day(calendar),
    )


def q_subscription_state(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_state(spark, folder, b.business_calendar(spark, folder)))


def q_nearest_pause(spark: SparkSession, folder: str) -> DataFrame:
    calendar = b.business_calendar(spark, folder)
    spine = expand_days(
        b.subscriptions(spark, folder), "start_date_pst", ["next_start_date_pst"], calendar, "date_day"
    ).select("uuid", "admin_user_id", "protocol", "date_day", "start_date_pst", "next_start_date_pst")
    return plain(nearest_pauses(spine, b.pauses(spark, folder), calendar))


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    calendar = b.business_calendar(spark, folder)
    state = cut_lineage(_state(spark, folder, calendar))
    return subscriptions.day_over_day_flags(state, b.pauses(spark, folder), calendar)


_SPOT = ["date_day", "uuid", "admin_user_id", "protocol", "subscription_sequence"]


def q_day_flags(spark: SparkSession, folder: str) -> DataFrame:
    # The flags of the daily table.
    columns = (
        "cancelled_today", "paused_today", "is_new_subscription", "is_new_user", "is_new_protocol_user",
        "is_past_renewal_date", "has_plan_change", "cancellation_reason", "past_pause_at", "future_pause_at",
    )
    return plain(_flags(spark, folder).select(*_SPOT, *columns))


def _active(spark: SparkSession, folder: str) -> DataFrame:
    return subscriptions.active_flag(_flags(spark, folder))


def q_active_flag(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_active(spark, folder).select(*_SPOT, "is_active"))


def _periods(spark: SparkSession, folder: str) -> DataFrame:
    active = cut_lineage(_active(spark, folder))
    return subscriptions.period_to_date(subscriptions.protocol_transitions(active))


def q_period_to_date(spark: SparkSession, folder: str) -> DataFrame:
    periods = _periods(spark, folder)
    flags = [c for c in periods.columns if "_this_" in c or c.endswith("bnpl_today") or c == "reactivated_today"]
    return plain(periods.select(*_SPOT, *flags))


def q_subscription_report(spark: SparkSession, folder: str) -> DataFrame:
    return plain(subscriptions.subscription_report(_periods(spark, folder)))


def q_switch_lag(spark: SparkSession, folder: str) -> DataFrame:
    subs = b.subscriptions(spark, folder)
    return plain(
        subs.select(
            F.col("uuid").alias("subscription_uuid"),
            F.concat("admin_user_id", "protocol").alias("user_protocol"),
            F.datediff("next_start_date_pst", "start_date_pst").alias("switch_lag"),
        )
    )


# --- requests ------------------------------------------------------------------


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    return requests.stage_requests(
        b.request_versions(spark, folder), b.medications(spark, folder), b.organizations(spark, folder)
    )


def q_stage_requests(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_staged(spark, folder))


def q_point_in_time(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staged(spark, folder).select("external_prescription_id", "patient_id", "prescription_created_date")
    matched = point_in_time_join(
        staged,
        b.patient_periods(spark, folder, "map_"),
        {"patient_id": "medplum_patient_id"},
        F.col("prescription_created_date"),
        "medplum_valid_from",
        "medplum_valid_through",
        ["external_prescription_id"],
    )
    return plain(matched)


def q_enrich_requests(spark: SparkSession, folder: str) -> DataFrame:
    enriched = requests.enrich_requests(
        _staged(spark, folder),
        b.shipments(spark, folder),
        b.status_events(spark, folder),
        b.patient_periods(spark, folder, "map_"),
        b.deleted_requests(spark, folder),
        b.dispenses(spark, folder),
        b.pharmacy_shipments(spark, folder),
        b.patient_periods(spark, folder, "dim_"),
        provider="main",
        medication_category=b.medication_category,
        combined_medications=["red widget", "blue bolt", "small ring"],
        pharmacy_dates={"first_shipment_date": "Pharmacy 1", "second_shipment_date": "Pharmacy 2"},
    )
    return plain(enriched)


def q_flatten_bundles(spark: SparkSession, folder: str) -> DataFrame:
    run_ts = F.lit(b.SCORED_AT).cast("timestamp")
    return plain(flatten_bundles(b.bundles(spark, folder), run_ts))


# --- upsert --------------------------------------------------------------------

def _newest_first() -> list[Column]:
    return [F.col("meta_lastupdated").desc(), F.col("meta_versionid").desc()]


def _loaded_before(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The table as an earlier run left it, and everything the source offers now."""
    source = b.request_versions(spark, folder)
    earlier = source.filter(F.col("meta_lastupdated") <= b.UPSERT_CUT)
    return latest_per_key(earlier, ["id"], _newest_first()), source


def q_upsert(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _loaded_before(spark, folder)
    target = cut_lineage(target)
    return plain(upsert(target, newer_than_target(source, target), "id", _newest_first()))


def q_high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _loaded_before(spark, folder)
    target = cut_lineage(target)
    stamp = F.lit(b.SCORED_AT).cast("timestamp")
    first = run_record(source.filter(F.col("meta_lastupdated") <= b.UPSERT_CUT), stamp)
    record = run_record(
        newer_than_target(source, target), stamp, synced_before=first.select("records_synced").scalar()
    )
    return plain(record.withColumn("previous_mark", high_water_mark(target).scalar()))


def q_landed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed as files in two runs, flattened and merged into a table with all columns."""
    place = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    stamp = F.lit(b.SCORED_AT).cast("timestamp")
    table = KeyedTable(spark, f"{place}/table", FLAT_SCHEMA)
    newer = F.col("meta_lastupdated") > b.UPSERT_CUT
    for run, part in enumerate((~newer, newer)):
        landing(b.bundle_pages(spark, folder, part)).text(f"{place}/landed/run={run}")
        landed = flatten_bundles(read_bundles(spark, f"{place}/landed/*"), stamp)
        sync(table, landed, first_mark="", run_ts=stamp, newest_first=_newest_first())
    return plain(table.read())


def q_redelivered_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed on a file stream in three runs, each run's pages older than the next one's last; old versions come last."""
    place = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    table = KeyedTable(spark, f"{place}/table", FLAT_SCHEMA, buckets=8)
    mark, middle = F.col("meta_lastupdated"), "1995-01-01T00:00:00.000Z"
    newest, old = mark > b.UPSERT_CUT, mark <= middle
    for run, part in enumerate((~newest & ~old, newest, old | newest)):
        landing(b.bundle_pages(spark, folder, part)).text(f"{place}/landed/run={run}")
        stream_into(table, bundle_stream(spark, f"{place}/landed/*"), f"{place}/checkpoint").awaitTermination()
    return plain(table.read().drop("_sync_timestamp"))


def q_bulk_load(spark: SparkSession, folder: str) -> DataFrame:
    """Flat rows as newline-delimited JSON with a field the table does not know, loaded in two parts."""
    place = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    rows = b.request_versions(spark, folder).withColumn("_sync_timestamp", F.lit(b.SCORED_AT).cast("timestamp"))
    newer = F.col("meta_lastupdated") > b.UPSERT_CUT
    for part, wanted in enumerate((~newer, newer)):
        lines = rows.filter(wanted).select(F.to_json(F.struct(*FLAT_SCHEMA.names, F.lit(part).alias("not_known"))))
        landing(lines).text(f"{place}/landed/{part}")
        load_flat(spark, f"{place}/landed/{part}", f"{place}/table")
    return plain(spark.read.schema(FLAT_SCHEMA).parquet(f"{place}/table"))


# --- tables ----------------------------------------------------------------------


def q_ordered_days(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the daily cancellations in the table that is written in their final order."""
    days = cut_lineage(_cancel_days(spark, folder, b.event_calendar(spark, folder)))
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    write_ordered(days, path, [F.col(c).asc_nulls_first() for c in (*CANCEL_DAILY_ORDER, "product_name")])
    return plain(read_numbered(spark, path, days.schema).select("position", "admin_user_id", "product_name", "cancelled_at", "day_date"))


# --- scoring -------------------------------------------------------------------


def _waiting(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.unscored(b.intakes(spark, folder), b.already_scored(spark, folder))


def q_unscored(spark: SparkSession, folder: str) -> DataFrame:
    return _waiting(spark, folder)


def q_score_batches(spark: SparkSession, folder: str) -> DataFrame:
    parsed, _, _ = scoring.score_freeform(
        b.intakes(spark, folder),
        b.already_scored(spark, folder),
        b.signal_scorer(),
        F.lit(b.SCORED_AT).cast("timestamp"),
        "signals-1",
    )
    return scoring.accepted(parsed)


def _parsed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    asked = cut_lineage(scoring.number_batches(_waiting(spark, folder)))
    responses = cut_lineage(b.made_responses(asked))
    run_ts = F.lit(b.SCORED_AT).cast("timestamp")
    return scoring.parse_scores(responses, asked, run_ts, "made-1"), asked


def q_parse_scores(spark: SparkSession, folder: str) -> DataFrame:
    parsed, _ = _parsed(spark, folder)
    return parsed


def q_score_summary(spark: SparkSession, folder: str) -> DataFrame:
    parsed, asked = _parsed(spark, folder)
    return scoring.run_summary(asked, parsed)


def q_score_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The table after three runs of the scoring job.

    The first run takes 300 rows; some of its batches fail and some come back too short.
    The second finds all that are left, and the third finds nothing and writes nothing.
    """
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    options = {"accept": scoring.long_enough(), "size": scoring.BATCH_SIZE}
    stamp = F.lit(b.SCORED_AT).cast("timestamp")
    for run, limit in (("run-1", 300), ("run-2", None), ("run-3", None)):
        scorer = b.faulty_scorer() if run == "run-1" else b.signal_scorer()
        scoring.score_into(path, b.intakes(spark, folder), scorer, stamp, run, limit=limit, **options)
    return plain(spark.read.schema(scoring.SCORED_SCHEMA).parquet(path))


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): function for name, function in list(globals().items()) if name.startswith("q_")
}

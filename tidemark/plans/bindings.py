"""Reference-shaped inputs derived from the benchmark tables.

Each function reads whole tables and returns one operator input. The SQL side of
the same derivations is in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import local_date
from tidemark.operators.cancellations import BUSINESS_ZONE, CANCELLED, UNCANCELLED
from tidemark.operators.intervals import calendar_days, calendar_of, expand_days
from tidemark.operators.keys import latest_per_key
from tidemark.operators.requests import FAVOURITE_CODES, NAME_EXTENSION, PHARMACY_NOTE, SNOMED_CODES, TEMPLATE_NOTE
from tidemark.operators.scoring import CATEGORIES, Scorer
from tidemark.sources.bundles import BUNDLE_SCHEMA
from tidemark.session import cut_lineage
from tidemark.sources import tables

PROTOCOLS = ("Weight Loss", "Mood, Stress & Sleep", "Testosterone")
LISTING_FLOOR = dt.date(2024, 1, 2)
CHANGE_COLUMNS = (
    "homesite_id",
    "report_date",
    "area_name",
    "comm_first_seen_avail_dt",
    "price",
    "status",
    "price_previous_report_dt",
    "status_previous_report_dt",
    "price_chg_dod",
    "sale_flag",
    "cancel_flag",
    "earliest_price",
    "latest_sale_dt",
    "latest_cancel_dt",
    "days_since_first_listed",
    "first_seen_avail_flag",
    "last_seen_avail_flag",
)
UPSERT_CUT = "1998-06-01T00:00:00.000Z"
#: Lines of one task, on average, where they become rows of a kilobyte or more.
LINES_PER_TASK = 100_000
SCORED_AT = "2024-06-01 00:00:00"


def pick(index: Column, *values: object) -> Column:
    """``values[index]``, null outside."""
    column = F.lit(None)
    for i, value in enumerate(values):
        column = F.when(index == i, F.lit(value)).otherwise(column)
    return column


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number ``k`` from their properties."""
    return load(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A benchmark table."""
    return tables.load(spark, folder, name)


# --- weekly status of an entity ------------------------------------------------


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Highest order status per nation, segment and week.

    The aggregate leaves one row per entity and week.
    """
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    customers = load(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy(
            F.col("c_nationkey").cast("bigint").alias("distribution_center"),
            F.col("c_mktsegment").alias("product_id"),
            F.to_date(F.date_trunc("week", "o_orderdate")).alias("report_week"),
        )
        .agg(F.max("o_orderstatus").alias("availability_status"))
    )


# --- homesites -----------------------------------------------------------------


def homesites(spark: SparkSession, folder: str) -> DataFrame:
    """Homesites in communities of three whose plan name changes over the month."""
    user = F.col("user_id")
    community = F.floor(user / 3).cast("bigint")
    step = F.floor((F.dayofmonth("ts") + 7 * (user % 3)) / 8).cast("int")
    return events(spark, folder).select(
        F.col("event_id"),
        user.alias("homesite_id"),
        community.alias("community_id"),
        F.concat(F.lit("P"), step.cast("string")).alias("floor_plan"),
        (community % 3 + 2).alias("bed"),
        (community % 2 + 1).alias("bath"),
        F.to_date("ts").alias("report_date"),
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Scraped listings, several a day for some homesites."""
    user, k = F.col("user_id"), F.col("k")
    community = F.floor(user / 3).cast("bigint").cast("string")
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    is_click = F.col("event_type") == "click"
    city = pick(user % 4, "Saint Paul", "San jose", "AUSTIN", "fort worth")
    state = pick(user % 4, "MN", "CA", "TX", "NV")
    zip_code = (F.lit(10000) + user % 90000).cast("string")
    text = lambda c: c.cast("string")
    return events(spark, folder).select(
        F.concat(F.lit("H"), text(user)).alias("homesite_id"),
        F.concat(F.lit("C"), community).alias("community_id"),
        F.concat(F.lit("Community "), community).alias("community_name"),
        F.concat(F.lit("Company "), text(user % 5)).alias("company"),
        F.concat(text(user), F.lit(" Main St")).alias("street_address"),
        F.when(k % 2 == 0, F.concat(city, F.lit(" "), state, F.lit(", "), zip_code))
        .otherwise(F.concat(city, F.lit(", "), state, F.lit(" "), zip_code))
        .alias("city_address"),
        pick(
            (user + F.floor(F.dayofmonth("ts") / 11)) % 4, "plan ii", "the oak-view ||", "o'hara iii", "SAGE"
        ).alias("floor_plan"),
        F.when(is_click & (k % 3 == 0), F.lit("Under Contract"))
        .when(is_click & (k % 3 == 1), F.lit("Coming Soon"))
        .when(k % 20 == 7, F.lit(None))
        .when(k % 4 == 0, F.concat(cents, F.lit(".50")))
        .otherwise(cents)
        .alias("price"),
        F.when(F.col("event_type").isin("view", "signup"), F.lit("Now Selling"))
        .when(F.col("event_type") == "purchase", F.lit("Under Contract"))
        .when(F.col("event_type") == "error", F.lit("Closed"))
        .alias("status"),
        F.to_date("ts").alias("run_date"),
        F.concat(
            F.lit('{"bed":"'), text(k % 5), F.lit('.25","bath":'), text(k % 3 + 1), F.lit(',"garage":"'),
            F.when(k % 7 == 0, F.lit("two")).otherwise(text(k % 3)), F.lit('","story":"'), text(k % 2 + 1),
            F.lit('.5","sqft":"'), text(F.lit(1000) + k * 10), F.lit('"}'),
        ).alias("house_info"),
        F.col("ts").alias("prefect_uploaded_at"),
        F.col("event_id").alias("load_order"),
    )


def communities(spark: SparkSession, folder: str) -> DataFrame:
    """Daily community rows under their reporting ids."""
    community = F.floor(F.floor(F.col("user_id") / 3) / 2).cast("bigint")
    daily = events(spark, folder).select(community.alias("c"), F.to_date("ts").alias("report_date")).distinct()
    return daily.select(
        F.concat(F.lit("R"), F.col("c").cast("string")).alias("community_id"),
        "report_date",
        F.concat(F.lit("Area "), ((F.col("c") + F.dayofmonth("report_date")) % 4).cast("string")).alias("area_name"),
        F.when(F.col("c") % 2 == 0, F.lit(dt.date(2024, 1, 2))).otherwise(F.lit(dt.date(2024, 1, 3))).alias(
            "first_seen_avail_dt"
        ),
    )


def community_map(spark: SparkSession, folder: str) -> DataFrame:
    """Two communities share a reporting id; every seventh has none."""
    listed = events(spark, folder).select(F.floor(F.col("user_id") / 3).cast("bigint").alias("c")).distinct()
    group = F.floor(F.col("c") / 2).cast("bigint").cast("string")
    return listed.select(
        F.concat(F.lit("C"), F.col("c").cast("string")).alias("community_id"),
        F.when(F.col("c") % 7 != 6, F.concat(F.lit("R"), group)).alias("rpt_community_id"),
        F.when(F.col("c") % 7 != 6, F.concat(F.lit("Region "), group)).alias("rpt_community_name"),
    )


def plan_map(clean: DataFrame, communities_map: DataFrame) -> DataFrame:
    """Standard plan names for the combinations seen, two-bath ones left out."""
    return (
        clean.join(communities_map.select("community_id", "rpt_community_id"), "community_id")
        .filter(F.col("bath") != 2)
        .select(
            F.col("rpt_community_id").alias("community_id"),
            "floor_plan",
            "bed",
            "bath",
            F.upper("floor_plan").alias("rpt_floor_plan"),
        )
        .distinct()
    )


# --- cancellations ---------------------------------------------------------------


def cancel_events(spark: SparkSession, folder: str) -> DataFrame:
    """Errors as cancellations and purchases as their withdrawal."""
    k = F.col("k")
    return events(spark, folder).select(
        F.col("user_id").cast("string").alias("admin_user_id"),
        F.when(k % 11 != 0, F.concat(F.lit("product_"), (k % 3).cast("string"))).alias("product_name"),
        F.when(F.col("event_type") == "error", F.lit(CANCELLED))
        .when(F.col("event_type") == "purchase", F.lit(UNCANCELLED))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("version"),
        F.when(k % 10 != 0, F.timestamp_add("HOUR", (k - 50).cast("int"), F.col("ts"))).alias("cancelled_at"),
        F.concat(F.lit("type_"), (k % 2).cast("string")).alias("operator_type"),
        F.concat(F.lit("op_"), (k % 13).cast("string")).alias("operator_id"),
        pick(k % 4, "Inactive System Cancel", "30+ days of billing issue", "asked").alias(
            "system_cancellation_reason"
        ),
        (k % 2 == 0).alias("cancel_immediately"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product names and their protocols."""
    numbers = events(spark, folder).select((F.col("k") % 3).alias("n")).distinct()
    return numbers.select(
        F.concat(F.lit("product_"), F.col("n").cast("string")).alias("product_name"),
        pick(F.col("n"), *PROTOCOLS).alias("protocol"),
    )


def event_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Every day from the first to the last event, in UTC."""
    return calendar_of(events(spark, folder), F.to_date("ts"))


# --- subscriptions -----------------------------------------------------------------


def _owned(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    return (
        events(spark, folder)
        .filter(F.col("event_type") == event_type)
        .select(
            F.col("user_id").cast("string").alias("admin_user_id"),
            pick(F.col("k") % 3, *PROTOCOLS).alias("protocol"),
            "ts",
            "event_id",
            "k",
            local_date(F.col("ts"), BUSINESS_ZONE).alias("day"),
        )
    )


def _newest(df: DataFrame, keys: list[str]) -> DataFrame:
    return latest_per_key(df, keys, [F.col("ts").desc(), F.col("event_id").desc()])


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """First signup per user, protocol and day; each ends where the next begins."""
    first = latest_per_key(
        _owned(spark, folder, "signup"), ["admin_user_id", "protocol", "day"],
        [F.col("ts").asc(), F.col("event_id").asc()],
    )
    # One row per day is left, so a window holds at most the days of the calendar.
    along = Window.partitionBy("admin_user_id", "protocol").orderBy("day")
    return first.withColumn("sequence", F.row_number().over(along).cast("bigint")).select(
        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("uuid"),
        "admin_user_id",
        "protocol",
        F.col("sequence").alias("subscription_sequence"),
        F.lead("sequence").over(along).alias("next_subscription_sequence"),
        F.col("ts").alias("start_date"),
        F.col("day").alias("start_date_pst"),
        F.lead("ts").over(along).alias("next_start_date"),
        F.lead("day").over(along).alias("next_start_date_pst"),
    )


def pauses(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks as pauses, announced up to four days ahead, some without an end."""
    k = F.col("k")
    shifted = _owned(spark, folder, "click").withColumn("paused_at", F.timestamp_add("DAY", (k % 5).cast("int"), F.col("ts")))
    resumed = F.when(k % 10 != 0, F.timestamp_add("DAY", (k % 7 + 1).cast("int"), F.col("paused_at")))
    return shifted.withColumn("resumed_at", resumed).select(
        "admin_user_id",
        "protocol",
        "paused_at",
        "resumed_at",
        local_date(F.col("paused_at"), BUSINESS_ZONE).alias("paused_date_pst"),
        local_date(F.col("resumed_at"), BUSINESS_ZONE).alias("resumed_date_pst"),
        F.col("day").alias("created_dt_pst"),
        "ts",
        "event_id",
    )


def business_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Every business day from the first to the last event.

    The two bounds are asked for once, as a subscription query reads the calendar in a dozen places.
    """
    day = local_date(F.col("ts"), BUSINESS_ZONE)
    first, last = events(spark, folder).agg(F.min(day), F.max(day)).first()
    return calendar_days(spark, first, last) if first else calendar_of(events(spark, folder), day)


def last_business_day(calendar: DataFrame) -> Column:
    """The day the report is made for."""
    return calendar.agg(F.max("date")).scalar()


def pause_days(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    """The newest pause in force per user, protocol and day."""
    days = expand_days(pauses(spark, folder), "paused_date_pst", ["resumed_date_pst"], calendar, "date_day")
    return _newest(days, ["admin_user_id", "protocol", "date_day"]).select(
        "admin_user_id",
        "protocol",
        "date_day",
        F.col("created_dt_pst").alias("pause_created_at_dt_pst"),
        F.col("paused_at").alias("pause_at"),
        F.col("resumed_at").alias("resume_at"),
    )


def billing_days(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    """Errors as billing issues of one to four days; the newest per user and day."""
    issues = _owned(spark, folder, "error").withColumn("until", F.date_add("day", (F.col("k") % 4 + 1).cast("int")))
    days = expand_days(issues, "day", ["until"], calendar, "date_day")
    return _newest(days, ["admin_user_id", "date_day"]).select(
        "admin_user_id",
        "date_day",
        F.col("ts").alias("billing_issue_from"),
        F.col("day").alias("billing_issue_from_date_pst"),
    )


def renewal_days(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    """Views as plan renewals known for ten days; the newest per user, protocol and day."""
    plans = (
        _owned(spark, folder, "view")
        .withColumn("active_mm_plan", pick(F.floor(F.col("k") / 3) % 3, 1, 3, 12).cast("bigint"))
        .withColumn("until", F.date_add("day", 10))
    )
    days = expand_days(plans, "day", ["until"], calendar, "date_day")
    return _newest(days, ["admin_user_id", "protocol", "date_day"]).select(
        "admin_user_id",
        "protocol",
        "date_day",
        F.col("day").alias("created_at_dt_pst"),
        "active_mm_plan",
        (F.col("active_mm_plan") * 30).alias("active_plan_days"),
    )


def order_days(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    """Purchases as orders, each standing until the next one of the user and protocol."""
    k = F.col("k")
    keys = ["admin_user_id", "protocol"]
    orders = _newest(_owned(spark, folder, "purchase"), [*keys, "day"])
    along = Window.partitionBy(*keys).orderBy("day")
    orders = orders.withColumn("until", F.lead("day").over(along)).withColumn("is_order", F.lit(1))
    # The subscription an order belongs to is the last one started by then: both
    # have one row per day, and a running last value carries the number along.
    started = subscriptions(spark, folder).select(
        *keys, F.col("start_date_pst").alias("day"), F.col("subscription_sequence").alias("sequence"),
        F.lit(0).alias("is_order"),
    )
    so_far = Window.partitionBy(*keys).orderBy("day", "is_order").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        orders.unionByName(started, allowMissingColumns=True)
        .withColumn("subscription_sequence", F.last("sequence", ignorenulls=True).over(so_far))
        .filter("is_order = 1")
    )
    days = expand_days(placed, "day", ["until"], calendar, "date_day")
    return days.select(
        *keys,
        "subscription_sequence",
        "date_day",
        F.concat(F.col("admin_user_id"), F.lit("@example.com")).alias("admin_email"),
        pick(k % 4, "Testosterone E/P", "Weight Loss Semaglutide Starter Pack", "Basic").alias("product_category_2"),
        pick(F.floor(k / 4) % 5, 1, 3, 12, 6).cast("bigint").alias("mm_plan"),
        F.col("ts").alias("order_transaction_date"),
        F.col("day").alias("order_transaction_dt"),
        F.when(F.floor(k / 5) % 4 == 0, F.lit(28) + k % 5).alias("billing_cycle_days"),
        F.when(F.floor(k / 2) % 3 == 0, "Yes").otherwise("No").alias("is_bnpl"),
        (k % 2 == 0).alias("is_bnpl_fod"),
        (k % 5 == 0).alias("contains_bb"),
        (k % 6 == 0).alias("contains_appt"),
    )


# --- medication requests -----------------------------------------------------------


def request_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as versions of a request, in the flat 45-field layout.

    Lines are dealt by their order while they are a few numbers, into tasks of an even
    number of lines, so that a task that sorts versions holds a bounded number of them and
    has all versions of a request.
    """
    table = load(spark, folder, "lineitem")
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(least, math.ceil(table.count() / LINES_PER_TASK))
    # Dealt first: lines with the same number are then put together without another shuffle.
    lines = (
        table.repartition(tasks, "l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.max("l_shipdate").alias("shipped"),
            F.min("l_partkey").alias("part"),
            F.min("l_suppkey").alias("supplier"),
            F.max("l_quantity").alias("quantity"),
        )
    )
    orders = load(spark, folder, "orders")
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("part")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = lambda c: c.cast("string")
    none = F.lit(None).cast("string")

    def numbered(prefix: str) -> Column:
        return F.concat(F.lit(prefix), text(order))

    first_system = pick(order % 4, "admin", "dosespot", "elation", "belmar")
    second_system = pick(order % 4, "dosespot", "elation", "belmar", "admin")
    odd = line % 2 == 1
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        text(order).alias("id"),
        F.lit("MedicationRequest").alias("resourcetype"),
        pick_status(F.col("o_orderstatus")).alias("status"),
        F.lit("order").alias("intent"),
        F.when(order % 5 == 0, F.concat(day, F.lit("T10:20:30Z")))
        .when(order % 5 == 1, F.concat(day, F.lit("T10:20:30.125+02:00")))
        .when(order % 5 == 2, day)
        .when(order % 5 == 3, F.concat(day, F.lit("T25:00:00Z")))
        .alias("authoredon"),
        F.lpad(text(line), 3, "0").alias("meta_versionid"),
        F.date_format("shipped", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("meta_lastupdated"),
        F.lit("match").alias("search_mode"),
        numbered("urn:request:").alias("fullurl"),
        F.concat(F.lit("Patient/"), text(F.col("o_custkey"))).alias("subject_reference"),
        F.lit("A patient").alias("subject_display"),
        F.when(order % 6 == 0, F.lit("Device/1")).otherwise(
            F.concat(F.lit("Practitioner/"), text(F.col("supplier")))
        ).alias("requester_reference"),
        none.alias("requester_display"),
        none.alias("performer_reference"),
        none.alias("performer_display"),
        F.lit("Practitioner/1").alias("recorder_reference"),
        F.lit("A recorder").alias("recorder_display"),
        F.when(odd, numbered("ServiceRequest/")).alias("basedon_reference"),
        first_system.alias("identifier_system_1"),
        F.concat(F.upper(F.substring(first_system, 1, 1)), text(order)).alias("identifier_value_1"),
        second_system.alias("identifier_system_2"),
        F.concat(F.upper(F.substring(second_system, 1, 1)), text(order)).alias("identifier_value_2"),
        pick(part % 3, FAVOURITE_CODES, SNOMED_CODES, "other").alias("medicationcodeableconcept_coding_system"),
        F.when(part % 10 == 0, F.lit("0")).otherwise(text(part)).alias("medicationcodeableconcept_coding_code"),
        F.when(part % 4 == 0, F.lit("None"))
        .when(part % 4 == 1, F.lit("Unknown Medication"))
        .when(part % 4 == 2, F.concat(F.lit("Med "), text(part)))
        .alias("medicationcodeableconcept_coding_display"),
        F.lit("Take it").alias("dosageinstruction_patientinstruction"),
        F.when(odd, F.lit(PHARMACY_NOTE)).otherwise(F.lit(TEMPLATE_NOTE)).alias("note_id_1"),
        none.alias("note_authorreference_reference_1"),
        none.alias("note_authorreference_display_1"),
        F.concat(F.lit("First NOTE (line "), text(line), F.lit(")")).alias("note_text_1"),
        F.when(odd, F.lit(TEMPLATE_NOTE)).otherwise(F.lit(PHARMACY_NOTE)).alias("note_id_2"),
        F.lit("Practitioner/2").alias("note_authorreference_reference_2"),
        F.lit("An author").alias("note_authorreference_display_2"),
        F.concat(F.lit("Second NOTE "), text(line)).alias("note_text_2"),
        line.cast("bigint").alias("dispenserequest_numberofrepeatsallowed"),
        F.col("quantity").alias("dispenserequest_quantity_value"),
        F.lit("tablet").alias("dispenserequest_quantity_unit"),
        (F.col("quantity") / 2).alias("dispenserequest_expectedsupplyduration_value"),
        F.lit("days").alias("dispenserequest_expectedsupplyduration_unit"),
        F.concat(F.lit("Organization/"), text(F.col("supplier"))).alias("dispenserequest_performer_reference"),
        F.lit("A pharmacy").alias("dispenserequest_performer_display"),
        F.when(order % 2 == 0, F.lit(NAME_EXTENSION)).otherwise(F.lit("note")).alias("extension_id"),
        F.lit("urn:extension").alias("extension_url"),
        F.when(order % 3 != 0, numbered("Ext ")).alias("extension_valuestring"),
        F.timestamp_add("DAY", F.lit(1), F.col("shipped")).alias("_sync_timestamp"),
    )


def pick_status(status: Column) -> Column:
    """Order status letters as request statuses."""
    return F.when(status == "F", "cancelled").when(status == "O", "active")


def medications(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as the medication dimension."""
    return load(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("dosespot_medication_id"), F.col("p_name").alias("medication_name")
    )


def organizations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as pharmacies, some without a reporting name."""
    nation = F.col("s_nationkey")
    return load(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("pharmacy_id"),
        F.col("s_name").alias("pharmacy_name"),
        F.when(nation % 3 != 0, F.concat(F.lit("Pharmacy "), nation.cast("string"))).alias("rpt_pharmacy_name"),
    )


def bundles(spark: SparkSession, folder: str, wanted: Column | None = None) -> DataFrame:
    """Request versions (the ``wanted`` ones) nested back into pages of two entries, through JSON text."""
    pages = bundle_pages(spark, folder, wanted)
    return pages.select(F.from_json("page", BUNDLE_SCHEMA, {"mode": "FAILFAST"}).alias("page")).select("page.*")


def bundle_pages(spark: SparkSession, folder: str, wanted: Column | None = None) -> DataFrame:
    """(page): the JSON text of each page, as it lands."""
    flat = request_versions(spark, folder)
    flat = flat if wanted is None else flat.filter(wanted)

    def reference(role: str) -> Column:
        return F.struct(F.col(f"{role}_reference").alias("reference"), F.col(f"{role}_display").alias("display"))

    def note(n: int) -> Column:
        author = F.struct(
            F.col(f"note_authorreference_reference_{n}").alias("reference"),
            F.col(f"note_authorreference_display_{n}").alias("display"),
        )
        return F.struct(
            F.col(f"note_id_{n}").alias("id"),
            F.when(F.col(f"note_authorreference_reference_{n}").isNotNull(), author).alias("authorReference"),
            F.col(f"note_text_{n}").alias("text"),
        )

    def amount(stem: str) -> Column:
        return F.struct(F.col(f"{stem}_value").alias("value"), F.col(f"{stem}_unit").alias("unit"))

    coding = "medicationcodeableconcept_coding"
    third_note = F.struct(F.lit("late").alias("id"), F.lit("not kept").alias("text"))

    def entry(suffix: str) -> Column:
        return F.struct(
            F.col("fullurl").alias("fullUrl"),
            F.struct(F.col("search_mode").alias("mode")).alias("search"),
            F.struct(
                F.concat("id", F.lit(suffix)).alias("id"),
                F.col("resourcetype").alias("resourceType"),
                "status",
                "intent",
                F.col("authoredon").alias("authoredOn"),
                F.struct(
                    F.col("meta_versionid").alias("versionId"), F.col("meta_lastupdated").alias("lastUpdated")
                ).alias("meta"),
                *[
                    F.when(F.col(f"{role}_reference").isNotNull(), reference(role)).alias(role)
                    for role in ("subject", "requester", "performer", "recorder")
                ],
                F.when(
                    F.col("basedon_reference").isNotNull(),
                    F.array(F.struct(F.col("basedon_reference").alias("reference"))),
                ).alias("basedOn"),
                F.array(
                    note(1), note(2), F.struct(third_note["id"].alias("id"), F.lit(None).cast(
                        "struct<reference: string, display: string>").alias("authorReference"),
                        third_note["text"].alias("text")),
                ).alias("note"),
                F.array(
                    *[
                        F.struct(
                            F.col(f"identifier_system_{n}").alias("system"),
                            F.col(f"identifier_value_{n}").alias("value"),
                        )
                        for n in (1, 2)
                    ]
                ).alias("identifier"),
                F.struct(
                    F.array(
                        F.struct(
                            F.col(f"{coding}_system").alias("system"),
                            F.col(f"{coding}_code").alias("code"),
                            F.col(f"{coding}_display").alias("display"),
                        )
                    ).alias("coding")
                ).alias("medicationCodeableConcept"),
                F.array(
                    F.struct(F.col("dosageinstruction_patientinstruction").alias("patientInstruction"))
                ).alias("dosageInstruction"),
                F.struct(
                    F.col("dispenserequest_numberofrepeatsallowed").alias("numberOfRepeatsAllowed"),
                    amount("dispenserequest_quantity").alias("quantity"),
                    amount("dispenserequest_expectedsupplyduration").alias("expectedSupplyDuration"),
                    F.struct(
                        F.col("dispenserequest_performer_reference").alias("reference"),
                        F.col("dispenserequest_performer_display").alias("display"),
                    ).alias("performer"),
                ).alias("dispenseRequest"),
                F.array(
                    F.struct(
                        F.col("extension_id").alias("id"),
                        F.col("extension_url").alias("url"),
                        F.col("extension_valuestring").alias("valueString"),
                    )
                ).alias("extension"),
            ).alias("resource"),
        )

    return flat.select(F.to_json(F.struct(F.array(entry(""), entry("-b")).alias("entry"))).alias("page"))


# --- inputs of the enrichment ---------------------------------------------------------


def _line_facts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        load(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_shipdate").alias("shipped"), F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supplier"))
        .withColumn("key", F.col("l_orderkey").cast("string"))
        .withColumn("line", F.col("l_linenumber").cast("bigint"))
        .withColumn("shipped_day", F.to_date("shipped"))
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as shipments; line one is the first fill, found by three ids."""
    order, line = F.col("l_orderkey"), F.col("line")
    external = (
        F.when(order % 3 == 0, F.col("key")).when(order % 3 == 1, F.concat(F.lit("E"), F.col("key")))
    )
    intake = pick(
        F.col("part") % 6, "onboarding", "follow_up", "weight_up_sustain", "hair_monthly_sustain",
        "mood_onboarding",
    )
    return _line_facts(spark, folder).select(
        external.alias("external_prescription_id"),
        F.concat(F.lit("A"), F.col("key")).alias("admin_prescription_id"),
        F.concat(F.lit("ship_"), F.col("supplier").cast("string")).alias("admin_user_id"),
        intake.alias("intake_name"),
        (line * 10).alias("days_supply"),
        F.when(F.col("part") % 5 != 0, F.col("shipped_day")).alias("date_shipped"),
        F.concat(F.lit("trk-"), F.col("key")).alias("tracking_number"),
        F.when(order % 2 == 0, "carrier a").alias("carrier"),
        F.col("shipped").alias("shpmt_created_at"),
        F.lit("pharmacist").alias("operator_type"),
        (line - 1).alias("refill_nbr"),
        F.lit(1).cast("bigint").alias("admin_with_shipping_nbr"),
    )


def status_events(spark: SparkSession, folder: str) -> DataFrame:
    """Status rows of the older pharmacy table, by rx number."""
    order = F.col("l_orderkey")
    return _line_facts(spark, folder).select(
        F.when(order % 8 < 4, F.concat(F.lit("D"), F.col("key"))).otherwise(F.concat(F.lit("X"), F.col("key"))).alias(
            "foreign_rx_number"
        ),
        F.col("shipped").alias("prescription_status_timestamp"),
        F.concat(F.lit("old-"), F.col("key"), F.lit("-"), F.col("line").cast("string")).alias("tracking_number"),
        F.lit("old carrier").alias("shipment_carrier"),
        F.lit("Shipped").alias("prescription_status"),
    )


def pharmacy_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """The pharmacy's own shipments, of two providers, one per rx number."""
    return load(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", "main").otherwise("second").alias("provider"),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("rx_number"),
        F.col("o_orderdate").alias("shipment_ts"),
        F.concat(F.lit("own-"), F.col("o_orderkey").cast("string")).alias("tracking_number"),
        F.lit("own carrier").alias("shipment_carrier"),
        F.lit("Sent").alias("prescription_status"),
    )


def deleted_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of one priority count as deleted."""
    return (
        load(spark, folder, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_orderkey").cast("string").alias("external_prescription_id"), F.lit(True).alias("is_deleted"))
    )


def dispenses(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines as dispenses."""
    part = F.col("part")
    return _line_facts(spark, folder).select(
        F.when(part % 4 == 0, F.col("key")).otherwise(F.concat(F.lit("none-"), F.col("key"))).alias(
            "external_prescription_id"
        ),
        (F.col("line") - 1).alias("refill_nbr"),
        F.lit(30).cast("bigint").alias("days_supply"),
        F.lit("raw pharmacy").alias("pharmacy_name_raw"),
        F.when(part % 8 == 0, "Dispensing pharmacy").alias("pharmacy_name"),
        F.col("shipped").alias("date_shipped"),
        (part % 3 == 0).alias("date_shipped_is_simple"),
        F.col("shipped").alias("api_last_updated"),
        F.when(part % 2 == 0, F.date_add("shipped_day", 10000)).otherwise(F.col("shipped_day")).alias(
            "api_last_updated_dt_pst"
        ),
        F.timestamp_add("DAY", F.lit(2), F.col("shipped")).alias("delivered_at"),
    )


def patient_periods(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Two adjoining validity periods per customer, each with its own user id."""
    customer = F.col("c_custkey").cast("string")
    instant = lambda s: F.lit(s).cast("timestamp")
    first = F.struct(
        instant("1994-01-01 00:00:00").alias("medplum_valid_from"),
        instant("1998-01-01 10:20:30").alias("medplum_valid_through"),
        F.lit("old").alias("part"),
    )
    second = F.struct(
        instant("1998-01-01 10:20:30").alias("medplum_valid_from"),
        instant("2000-01-01 00:00:00").alias("medplum_valid_through"),
        F.lit("new").alias("part"),
    )
    return (
        load(spark, folder, "customer")
        .select(customer.alias("medplum_patient_id"), F.explode(F.array(first, second)).alias("p"))
        .select(
            "medplum_patient_id",
            F.concat(F.lit(prefix), "medplum_patient_id", F.lit("_"), "p.part").alias("admin_user_id"),
            "p.medplum_valid_from",
            "p.medplum_valid_through",
        )
    )


def medication_category(name: Column) -> Column:
    """Category taken from a word of the medication name."""
    return F.when(name.contains("bolt"), "bolt").when(name.contains("ring"), "ring").otherwise("other")


# --- free text ----------------------------------------------------------------------


def intakes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as survey answers."""
    return load(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("uuid"),
        F.col("text").alias("goals_freeform"),
        F.col("lang").alias("protocol"),
        F.when(F.col("n_chars") % 2 == 0, "New").otherwise("Refill").alias("new_refill"),
        F.timestamp_add("DAY", (F.col("doc_id") % 60).cast("int"), F.lit("2023-12-20 12:00:00").cast("timestamp")).alias(
            "intake_completed_at"
        ),
    )


def already_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents count as scored."""
    return load(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("uuid"))


# The deterministic scorer of tests and bench: per category a word that scores 1
# and one that scores -1, looked for anywhere in the text.
SIGNALS = {
    c: (up, down)
    for c, (up, down) in zip(
        CATEGORIES,
        [("that", "nicht"), ("with", "pour"), ("this", "und"), ("from", "les"), ("tion", "der"), ("ing", "una"),
         ("able", "que"), ("ment", "ist"), ("eau", "est"), ("ch", "los"), ("ous", "die"), ("ent", "por"),
         ("ter", "zz"), ("ver", "qq"), ("and", "el"), ("en", "xx"), ("zu", "yy")],
        strict=True,
    )
}


def signal_scorer() -> Scorer:
    """One JSON object per row of the batch, on a line each.

    A closure over its table, so that it travels to executors without this package.
    """
    signals, dumps = SIGNALS, json.dumps

    def score(_text: str, rows: list[dict]) -> str:
        lines = []
        for row in rows:
            answer = row["goals_freeform"]
            scores = {c: 1 if up in answer else -1 if down in answer else None for c, (up, down) in signals.items()}
            lines.append(dumps({"uuid": row["uuid"], **scores}))
        return "\n".join(lines)

    return score


def faulty_scorer() -> Scorer:
    """The signal scorer with token counts; by the first row's number some batches fail and some are too short."""
    score = signal_scorer()

    def answer(text: str, rows: list[dict]) -> tuple[str, int]:
        first = int(rows[0]["uuid"])
        if first % 7 == 0:
            raise RuntimeError("no answer")
        return score(text, rows), 999 if first % 5 == 0 else 1000

    return answer


def made_responses(requests: DataFrame) -> DataFrame:
    """Raw responses with the faults a scorer shows, derived from the batch numbers.

    Lines may be repeated with another score, broken, or name an unknown row; some
    batches are fenced, some spread each object over several lines and some leave
    a row out.
    """
    uuid = F.col("uuid")
    number = F.length("goals_freeform") % 3 - 1
    skipped = (F.col("batch_id") % 4 == 3) & (F.col("position") == 2)
    spread = F.col("batch_id") % 3 == 1

    def line(who: Column, first: Column) -> Column:
        return F.concat(
            F.lit('{"uuid": "'), who, F.lit('", "anxiety": '), first, F.lit(', "diet": null, "general": "1"}')
        )

    plain = F.concat_ws(
        "\n",
        line(uuid, F.lit("null")),
        F.when(F.col("position") % 5 != 0, F.concat(F.lit("  "), line(uuid, number.cast("string")), F.lit("\r"))),
        F.lit('{"uuid": broken}'),
        line(F.concat(F.lit("unknown-"), uuid), F.lit("1")),
    )
    wide = F.concat(
        F.lit('Here it is: {\n "uuid": "'), uuid, F.lit('",\n "anxiety": '), number.cast("string"),
        F.lit(',\n "more": {"a": 1}\n}'),
    )
    piece = F.when(skipped, F.lit("")).otherwise(F.when(spread, wide).otherwise(plain))
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("position", piece.alias("t")))), lambda x: x["t"]), "\n"
    )
    fenced = F.concat(F.lit("```json\n"), F.col("body"), F.lit("\n```"))
    return (
        requests.groupBy("batch_id")
        .agg(body.alias("body"))
        .select("batch_id", F.when(F.col("batch_id") % 2 == 0, fenced).otherwise(F.col("body")).alias("response"))
    )

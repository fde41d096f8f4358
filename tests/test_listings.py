import datetime as dt
import json

import pytest

from tests.helpers import day, rows, ts
from tidemark.operators import listings as li

RAW = (
    "homesite_id string, community_id string, community_name string, company string, street_address string, "
    "city_address string, floor_plan string, price string, status string, run_date date, house_info string, "
    "prefect_uploaded_at timestamp"
)
FLOOR = dt.date(2024, 10, 14)


def raw(spark, data):
    """(homesite, run date, status, price[, overrides])"""
    full = []
    for site, run, status, price, *rest in data:
        o = rest[0] if rest else {}
        full.append(
            (site, o.get("community", "C"), "name", "company", "street", o.get("city", "Austin TX, 78701"),
             o.get("plan", "plan one"), price, status, day(run), json.dumps(o.get("house", {"bed": "3", "bath": 2})),
             ts(o.get("at", f"{run} 12:00")))
        )
    return spark.createDataFrame(full, RAW)


def through(spark, data, standard=("Standard",)):
    listings = li.clean_listings(raw(spark, data), FLOOR)
    communities = spark.createDataFrame(
        [("R", day("2024-10-15"), "Area", day("2024-10-20"))],
        "community_id string, report_date date, area_name string, first_seen_avail_dt date",
    )
    names = spark.createDataFrame([("C", "R", "Region")], "community_id string, rpt_community_id string, rpt_community_name string")
    plans = spark.createDataFrame(
        [("R", "Plan One", name) for name in standard], "community_id string, floor_plan string, rpt_floor_plan string"
    ).selectExpr("*", "cast(3 as decimal(6,1)) bed", "cast(2 as decimal(6,1)) bath")
    named = li.standardise_dims(listings, names, plans)
    return rows(li.days_on_market(li.snapshot_changes(named, communities)), "homesite_id", "report_date")


@pytest.mark.parametrize(
    ("address", "expected"),
    [
        ("Austin TX, 78701", ("Austin", "TX", "78701")),
        ("Austin, TX 78701", ("Austin", "TX", "78701")),
        ("Saint Paul MN, 55101", ("St. Paul", "MN", "55101")),
        ("fort worth, TX 76102", ("Fort Worth", "TX", "76102")),
        (None, (None, None, None)),
    ],
)
def test_address_parts(spark, address, expected):
    df = raw(spark, [("h", "2024-10-20", None, "1", {"city": address})])
    found = li.clean_listings(df, FLOOR).first()
    assert (found.city, found.state, found.zip_code) == expected


def test_status_in_the_price_column(spark):
    data = [("a", "2024-10-20", None, "Under Contract"), ("b", "2024-10-20", None, "450000.50"),
            ("c", "2024-10-20", "Now Selling", "450000"), ("d", "2024-10-20", None, None)]
    found = rows(li.clean_listings(raw(spark, data), FLOOR), "homesite_id")
    assert [(r["status"], r["price"]) for r in found] == [
        ("Under Contract", None), (None, 450000.5), ("Now Selling", 450000.0), (None, None),
    ]


def test_date_floor_is_on_the_lagged_date_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, [("a", "2024-10-14", None, "1"), ("a", "2024-10-15", None, "2")]).write.parquet(path)
    clean = li.clean_listings(spark.read.parquet(path), FLOOR)
    assert [r.report_date for r in clean.collect()] == [day("2024-10-14")]
    plan = spark._jvm.PythonSQLUtils.explainString(clean._jdf.queryExecution(), "simple")
    assert "GreaterThanOrEqual(run_date,2024-10-15)" in plan


def test_plan_names_and_newest_traits(spark):
    data = [("a", "2024-10-20", None, "1", {"plan": "the oak ii", "house": {"bed": "2.25", "bath": None, "sqft": "x"}}),
            ("a", "2024-10-21", None, "1", {"plan": "the oak ||", "house": {"bed": "4", "bath": "two"}}),
            ("a", "2024-10-21", None, "9", {"at": "2024-10-21 10:00", "house": {"bed": "7"}})]
    found = rows(li.clean_listings(raw(spark, data), FLOOR), "report_date")
    assert [r["floor_plan"] for r in found] == ["The Oak II", "The Oak II"]
    assert [float(r["bed"]) for r in found] == [4.0, 4.0]
    assert [r["bath"] for r in found] == [None, None]
    assert [r["price"] for r in found] == [1.0, 1.0]


def test_sale_cancel_and_days_on_market(spark):
    data = [
        ("a", "2024-10-17", "Now Selling", "100"), ("a", "2024-10-18", "Under Contract", "100"),
        ("a", "2024-10-19", "Now Selling", "90"), ("a", "2024-10-21", "Under Contract", "90"),
        ("a", "2024-10-24", "Closed", "90"),
    ]
    found = through(spark, data)
    assert [r["sale_flag"] for r in found] == [False, True, False, True, False]
    assert [r["cancel_flag"] for r in found] == [False, False, True, False, False]
    assert [r["price_chg_dod"] for r in found] == [None, 0.0, -10.0, 0.0, 0.0]
    # Sold; then cancelled and sold again: counted from the latest cancellation to the latest sale.
    assert [r["days_on_market"] for r in found] == [0, 1, 0, 2, 2]
    assert [r["days_since_first_listed"] for r in found] == [0, 1, 2, 4, 4]
    assert {r["floor_plan"] for r in found} == {"Standard"}
    assert {r["area_name"] for r in found} == {"Area"}


def test_null_status_before_a_sale_takes_the_old_price_but_raises_no_flag(spark):
    found = through(spark, [("a", "2024-10-17", None, "100"), ("a", "2024-10-18", None, "Under Contract")])
    assert [r["sale_flag"] for r in found] == [False, False]
    assert found[1]["price"] == 100.0 and found[1]["earliest_price"] == 100.0
    assert found[0]["first_seen_avail_dt"] is None


def test_unmapped_community_has_null_names(spark):
    found = through(spark, [("a", "2024-10-17", "Now Selling", "1", {"community": "unknown"})])
    assert (found[0]["community_id"], found[0]["community_name"], found[0]["floor_plan"]) == (None, None, None)


def test_a_plan_in_two_chains_compares_every_copy_with_every_copy_before(spark):
    data = [("a", "2024-10-17", "Now Selling", "100"), ("a", "2024-10-18", "Under Contract", "90")]
    found = through(spark, data, standard=("Standard", "Also Standard"))
    first, second = found[:2], found[2:]
    assert len(second) == 4 and sorted(r["floor_plan"] for r in second) == ["Also Standard"] * 2 + ["Standard"] * 2
    assert all(r["status_previous_report_dt"] is None and not r["sale_flag"] for r in first)
    assert all(r["sale_flag"] and r["price_previous_report_dt"] == 100.0 for r in second)
    assert {r["latest_sale_dt"] for r in second} == {day("2024-10-17")}
    assert {r["sale_count"] for r in first} == {0} and {r["sale_count"] for r in second} == {4}


def test_snapshots_are_read_and_dealt_once(spark, tmp_path):
    """One scan of the listings; one shuffle by homesite besides those that the communities' join may take."""
    path = str(tmp_path / "named")
    data = [(f"h{k % 7}", f"2024-10-{17 + k // 7}", ("Now Selling", "Under Contract", None)[k % 3], str(k)) for k in range(49)]
    clean = li.clean_listings(raw(spark, data), FLOOR)
    clean.withColumnRenamed("community_id", "c").withColumnRenamed("c", "community_id").write.parquet(path)
    communities = spark.createDataFrame([("C", day("2024-10-15"), "Area", day("2024-10-20"))], "community_id string, report_date date, area_name string, first_seen_avail_dt date")
    changes = li.snapshot_changes(spark.read.parquet(path), communities)
    assert len(changes.collect()) == 49
    plan = changes._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    assert plan.count("hashpartitioning(homesite_id") == 1


def test_rows_without_a_homesite_have_no_day_before(spark):
    data = [("a", "2024-10-17", "Now Selling", "100"), ("a", "2024-10-18", "Under Contract", "90"), (None, "2024-10-17", "Now Selling", "7"), (None, "2024-10-18", "Under Contract", "8")]
    found = through(spark, data)
    assert [r["price_previous_report_dt"] for r in found if r["homesite_id"] is None] == [None, None]
    assert [r["price_previous_report_dt"] for r in found if r["homesite_id"] == "a"] == [None, 100.0]

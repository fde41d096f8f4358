import pytest
from pyspark.sql import functions as F

from tests.helpers import day, rows, ts
from tidemark.operators import subscriptions as su
from tidemark.operators.intervals import calendar_days
from tidemark.session import cut_lineage

SUBS = (
    "uuid string, admin_user_id string, protocol string, subscription_sequence long, next_subscription_sequence long, "
    "start_date timestamp, start_date_pst date, next_start_date timestamp, next_start_date_pst date"
)
EMPTY = {
    "pauses": "admin_user_id string, protocol string, date_day date, pause_created_at_dt_pst date, pause_at timestamp, resume_at timestamp",
    "cancels": (
        "day_date date, admin_user_id string, protocol string, cancellation_created_at timestamp, cancelled_at timestamp, "
        "cancelled_at_dt_pst date, cancelled_at_pst timestamp_ntz, is_autocancel int, system_cancellation_reason string, "
        "actively_cancelled boolean, cancelled_in_future boolean, future_cancel_created_at timestamp, "
        "future_cancel_created_dt_pst date, future_cancel_scheduled_for timestamp, future_cancel_scheduled_for_dt_pst date, "
        "future_cancel_is_autocancel int, future_cancel_system_cancellation_reason string"
    ),
    "billing": "admin_user_id string, date_day date, billing_issue_from timestamp, billing_issue_from_date_pst date",
    "renewals": "admin_user_id string, protocol string, date_day date, created_at_dt_pst date, active_mm_plan long, active_plan_days long",
    "orders": (
        "admin_user_id string, protocol string, subscription_sequence long, date_day date, admin_email string, "
        "product_category_2 string, mm_plan long, order_transaction_date timestamp, order_transaction_dt date, "
        "billing_cycle_days long, is_bnpl string, is_bnpl_fod boolean, contains_bb boolean, contains_appt boolean"
    ),
}
PAUSE_LOG = "admin_user_id string, protocol string, paused_at timestamp, paused_date_pst date, resumed_date_pst date, created_dt_pst date"


def state(spark, subs, last="2025-07-10", **inputs):
    calendar = calendar_days(spark, day("2025-06-01"), day("2025-08-31"))
    frames = {n: spark.createDataFrame(inputs.get(n, []), schema) for n, schema in EMPTY.items()}
    return su.subscription_daily(
        spark.createDataFrame(subs, SUBS), frames["pauses"], frames["cancels"], frames["billing"],
        frames["renewals"], frames["orders"], calendar, F.lit(day(last)),
    )


def sub(uuid, start, following=None, user="u", protocol="Weight Loss", sequence=1):
    return (uuid, user, protocol, sequence, sequence + 1 if following else None, ts(f"{start} 20:00"), day(start),
            ts(f"{following} 20:00") if following else None, day(following))


def order(d, placed, category="Basic", plan=1, cycle=None, bnpl="No", sequence=1, protocol="Weight Loss"):
    return ("u", protocol, sequence, day(d), "e", category, plan, ts(f"{placed} 12:00"), day(placed), cycle, bnpl,
            False, False, False)


def test_spine_ends_before_the_next_subscription_and_at_the_report_day(spark):
    found = state(spark, [sub("s1", "2025-07-01", "2025-07-04"), sub("s2", "2025-07-04", sequence=2)], "2025-07-06")
    assert [(r["uuid"], r["date_day"].day) for r in rows(found, "uuid", "date_day")] == [
        ("s1", 1), ("s1", 2), ("s1", 3), ("s2", 4), ("s2", 5), ("s2", 6),
    ]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ({"category": su.STARTER_PACK, "bnpl": "Yes"}, "2025-10-14"),
        ({"bnpl": "Yes", "cycle": 10}, "2025-08-01"),
        ({"cycle": 10, "plan": 12}, "2025-07-11"),
        ({"plan": 3}, "2025-10-01"),
        ({"plan": None}, "2025-08-01"),
    ],
)
def test_renewal_date_precedence(spark, given, expected):
    found = state(spark, [sub("s", "2025-07-01")], "2025-07-01", orders=[order("2025-07-01", "2025-07-01", **given)])
    assert found.first().renewal_or_end_date == ts(f"{expected} 00:00")


def test_plan_change_and_protocol_without_renewals(spark):
    renewals = [("u", p, day("2025-07-01"), day("2025-07-01"), 3, 90) for p in ("Weight Loss", "Growth Hormone")]
    subs = [sub("s", "2025-07-01"), sub("g", "2025-07-01", protocol="Growth Hormone")]
    orders = [order("2025-07-01", "2025-07-01"), order("2025-07-01", "2025-07-01", protocol="Growth Hormone")]
    found = rows(state(spark, subs, "2025-07-01", renewals=renewals, orders=orders), "uuid")
    assert [(r["uuid"], r["active_mm_plan"], r["subscription_length"]) for r in found] == [("g", None, 1), ("s", 3, 3)]


def test_orders_of_another_sequence_or_term_do_not_match(spark):
    orders = [order("2025-07-05", "2025-07-05", sequence=2), order("2025-07-06", "2025-06-20")]
    found = state(spark, [sub("s", "2025-07-01")], "2025-07-06", orders=orders)
    assert {r.last_transaction_dt for r in found.collect()} == {None}


def test_cancellation_state_and_tenure(spark):
    blank = [None] * 6
    cancels = [
        (day("2025-07-09"), "u", "Weight Loss", None, None, None, None, 0, None, False, True, ts("2025-07-09 20:00"),
         day("2025-07-09"), ts("2025-07-12 20:00"), day("2025-07-12"), 1, "why"),
        (day("2025-07-10"), "u", "Weight Loss", ts("2025-07-09 20:00"), ts("2025-07-10 20:00"), day("2025-07-10"), None, 1,
         "because", True, False, *blank),
    ]
    found = rows(state(spark, [sub("s", "2025-07-01")], "2025-07-10", cancels=cancels), "date_day")
    before, ahead, now = found[-3:]
    assert (before["is_cancelled"], ahead["is_cancelled"], ahead["is_cancelled_today"]) == (False, True, False)
    assert ahead["has_future_intended_cancellation"] and ahead["system_cancellation_reason"] == "why"
    assert now["is_cancelled_today"] and now["tenure_months"] == 0.3 and now["is_autocancel"] == 1


def pipeline(spark, daily):
    calendar = calendar_days(spark, day("2025-06-01"), day("2025-08-31"))
    flags = su.day_over_day_flags(daily, spark.createDataFrame([], PAUSE_LOG), calendar)
    return su.period_to_date(su.protocol_transitions(su.active_flag(flags)))


def test_flags_and_periods(spark):
    # 2025-06-29 is a Sunday: the new week begins on the 30th, the new month on the day after.
    orders = [order(f"2025-06-{d}", "2025-06-28", bnpl="No") for d in (28, 29)] + [
        order("2025-06-30", "2025-06-28", bnpl="Yes"), order("2025-07-01", "2025-06-28", bnpl="No"),
    ]
    billing = [("u", day("2025-06-29"), ts("2025-06-29 12:00"), day("2025-06-29"))]
    daily = state(spark, [sub("s", "2025-06-28")], "2025-07-02", orders=orders, billing=billing)
    found = rows(pipeline(spark, daily), "date_day")
    column = lambda name: [r[name] for r in found]
    assert column("is_new_user") == [True, False, False, False, False]
    assert column("is_new_subscription") == [True, False, False, False, False]
    assert column("is_new_user_this_week") == [True, True, False, False, False]
    assert column("is_new_user_this_month") == [True, True, True, False, False]
    assert column("is_active") == [True, False, True, True, False]
    assert column("reactivated_today") == [False, False, True, False, False]
    assert column("reactivated_sub_this_month") == [False, False, True, False, False]
    assert column("reactivated_user_this_week") == [False, False, True, True, True]
    assert column("became_bnpl_today") == [False, False, True, False, False]
    assert column("exited_bnpl_today") == [False, False, False, True, False]
    report = su.subscription_report(pipeline(spark, daily))
    assert report.columns == list(su.REPORT_COLUMNS) and report.count() == 5


def test_two_subscriptions_of_one_protocol_fan_out_over_yesterday(spark):
    subs = [sub("s1", "2025-07-01"), sub("s2", "2025-07-01", sequence=2)]
    found = pipeline(spark, state(spark, subs, "2025-07-02"))
    assert found.filter("date_day = date'2025-07-01'").count() == 2
    assert found.filter("date_day = date'2025-07-02'").count() == 4


def test_period_flags_add_one_exchange_per_period(spark):
    daily = state(spark, [sub("s", "2025-06-28")], "2025-07-02")
    base = su.protocol_transitions(su.active_flag(daily.withColumn("is_past_renewal_date", F.lit(False)))).withColumns(
        {"is_new_user": F.lit(True), "is_new_protocol_user": F.lit(True)}
    )
    explain = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert explain(su.period_to_date(base)).count("Exchange") - explain(base).count("Exchange") <= 2


def test_two_products_of_one_protocol_leave_one_row_whatever_the_partitions(spark):
    def cancel(at, reason):
        blank = [None] * 6
        return (day("2025-07-02"), "u", "Weight Loss", ts("2025-07-01 20:00"), ts(at), day("2025-07-02"), None, 1, reason, True, False, *blank)

    daily = state(spark, [sub("s", "2025-07-01")], "2025-07-02", cancels=[cancel("2025-07-02 20:00", "b"), cancel("2025-07-02 21:00", "a")])
    assert daily.filter("date_day = date'2025-07-02'").count() == 2
    seen = set()
    for n in (1, 3, 7):
        flags = pipeline(spark, daily.repartition(n)).filter("date_day = date'2025-07-02'").collect()
        assert len(flags) == 1
        seen.add((flags[0].system_cancellation_reason, flags[0].intended_cancellation_date))
    assert len(seen) == 1


def unkeyed_days(spark):
    """Nine hundred subscription days: a third without a protocol, a third of those without a user either."""
    subs = []
    for k in range(90):
        protocol, user = (None if k % 3 == 0 else "Weight Loss"), (None if k % 9 == 0 else f"u{k % 20}")
        subs.append(sub(f"s{k}", "2025-07-01", user=user, protocol=protocol, sequence=k))
    pauses = [(f"u{k}", "Weight Loss", day("2025-07-03"), day("2025-07-02"), ts("2025-07-03 00:00"), None) for k in range(20)]
    pauses += [(None, None, day("2025-07-03"), day("2025-07-02"), ts("2025-07-03 00:00"), None)]
    billing = [("u1", day("2025-07-04"), ts("2025-07-04 12:00"), day("2025-07-04"))]
    return subs, state(spark, subs, "2025-07-10", pauses=pauses, billing=billing)


def test_days_without_a_key_are_spread_and_match_nothing(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for key, value in zip(before, ("-1", "8", "false")):
        spark.conf.set(key, value)
    try:
        subs, daily = unkeyed_days(spark)
        tasks = sorted(r["count"] for r in daily.groupBy(F.spark_partition_id().alias("task")).count().collect())
        plan = daily._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(tasks) == 900 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    paused = {r.uuid for r in daily.filter("is_paused").collect()}
    assert paused == {s[0] for s in subs if s[1] and s[2]}
    billed = {r.uuid for r in daily.filter("has_billing_issue").collect()}
    assert billed == {s[0] for s in subs if s[1] == "u1"}


def test_first_days_of_rows_without_a_user(spark):
    """To a window all rows without a user are one user; found apart, their flags are those of that window."""
    _, daily = unkeyed_days(spark)
    found = rows(pipeline(spark, daily), "date_day", "uuid")
    for keys, flag in ((("admin_user_id",), "is_new_user"), (("admin_user_id", "protocol"), "is_new_protocol_user")):
        first = {}
        for r in found:
            place = tuple((r[c] is not None, r[c]) for c in (("date_day", "protocol", "start_date_pst", "uuid") if len(keys) == 1 else ("date_day", "start_date_pst", "uuid")))
            owner = tuple(r[k] for k in keys)
            first[owner] = min(first.get(owner, place), place)
        for r in found:
            place = tuple((r[c] is not None, r[c]) for c in (("date_day", "protocol", "start_date_pst", "uuid") if len(keys) == 1 else ("date_day", "start_date_pst", "uuid")))
            assert r[flag] == (place == first[tuple(r[k] for k in keys)])
    new = {(r["uuid"], r["date_day"].day) for r in found if r["is_new_subscription"]}
    assert new == {(f"s{k}", 1) for k in range(90)}
    began = {r["uuid"] for r in found if r["paused_today"]}
    assert began == {r["uuid"] for r in found if r["is_paused"]}


def test_rows_are_moved_and_sorted_with_few_columns(spark, capsys):
    calendar = calendar_days(spark, day("2025-06-01"), day("2025-08-31"))
    daily = state(spark, [sub("s1", "2025-07-01"), sub("s2", "2025-07-02", user="v")])
    flags = su.day_over_day_flags(daily, spark.createDataFrame([], PAUSE_LOG), calendar)
    periods = su.period_to_date(su.protocol_transitions(cut_lineage(su.active_flag(flags))))
    first = ["admin_user_id", "protocol", "date_day"]
    assert flags.columns[: len(daily.columns)] == [*first, *(c for c in daily.columns if c not in first)]
    for frame in (flags.filter("admin_user_id is not null"), periods):
        frame.explain("formatted")
        steps = [s for s in capsys.readouterr().out.split("\n\n") if ") Exchange\n" in s]
        widths = [int(s.split("Input [")[1].split("]")[0]) for s in steps if "uuid#" in s]
        assert len(frame.columns) > 50 and widths and min(widths) <= 16
    assert max(widths) <= 30

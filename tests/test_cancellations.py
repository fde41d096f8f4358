import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, day, rows, ts
from tidemark.operators.cancellations import CANCELLED, UNCANCELLED, cancel_daily, cancellation_timeline
from tidemark.operators.intervals import calendar_days, expand_days, nearest_pauses

EVENTS = (
    "admin_user_id string, product_name string, event_type string, created_at timestamp, version long, "
    "cancelled_at timestamp, operator_type string, operator_id string, system_cancellation_reason string, "
    "cancel_immediately boolean"
)


def events(spark, data):
    """(user, type, created, version, cancelled_at[, reason])"""
    full = [
        (u, "p", CANCELLED if t == "c" else UNCANCELLED, ts(at), v, ts(c), "o", "1", *(rest or [None]), False)
        for u, t, at, v, c, *rest in data
    ]
    return spark.createDataFrame(full, EVENTS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("p", "proto")], "product_name string, protocol string")


def timeline(spark, products, data, **kw):
    return rows(cancellation_timeline(events(spark, data), products, **kw), "admin_user_id", "cancellation_created_at")


def test_newest_of_a_run_wins_and_ties_go_to_the_lowest_version(spark, products):
    found = timeline(
        spark, products,
        [
            ("a", "c", "2024-01-01 10:00", 1, "2024-01-05 00:00"),
            ("a", "c", "2024-01-02 10:00", 3, "2024-01-07 00:00"),
            ("a", "c", "2024-01-02 10:00", 2, "2024-01-06 00:00"),
            ("a", "u", "2024-01-20 10:00", 4, None),
        ],
    )
    assert len(found) == 1
    assert found[0]["cancelled_at"] == ts("2024-01-06 00:00")
    assert found[0]["uncancelled_at"] == ts("2024-01-20 10:00")
    assert found[0]["valid_from"] == ts("1900-01-01 00:00")


def test_cancel_taken_back_in_time_is_dropped_and_next_is_first(spark, products):
    found = timeline(
        spark, products,
        [
            ("a", "c", "2024-01-01 10:00", 1, "2024-02-01 00:00"),
            ("a", "u", "2024-01-10 10:00", 2, None),
            ("a", "c", "2024-01-15 10:00", 3, None),
        ],
    )
    assert [r["cancellation_created_at"] for r in found] == [ts("2024-01-15 10:00")]
    assert found[0]["cancelled_at"] == ts("2024-01-15 10:00")
    assert found[0]["valid_from"] == ts("1900-01-01 00:00")


def test_stale_date_of_an_earlier_cancel_is_replaced_by_the_event_time(spark, products):
    found = timeline(
        spark, products,
        [
            ("a", "c", "2024-01-01 10:00", 1, "2024-01-02 00:00"),
            ("a", "u", "2024-01-10 10:00", 2, None),
            ("a", "c", "2024-01-15 10:00", 3, "2024-01-02 00:00"),
        ],
    )
    assert found[1]["cancelled_at"] == ts("2024-01-15 10:00")
    assert found[1]["valid_from"] == ts("2024-01-10 10:00")
    assert found[0]["next_cancellation_created_at"] == ts("2024-01-15 10:00")


def test_local_days(spark, products):
    found = timeline(spark, products, [("a", "c", "2024-01-01 03:00", 1, "2024-07-01 06:59")])[0]
    assert found["cancellation_created_at_dt_pst"] == day("2023-12-31")
    assert found["cancelled_at_dt_pst"] == day("2024-06-30")
    assert found["cancelled_at_dt_utc"] == day("2024-07-01")
    assert found["cancelled_at_pst"] == ts("2024-06-30 23:59")


def random_events(seed, n=300):
    random.seed(seed)
    data = []
    for i in range(n):
        at = f"2024-01-{random.randrange(1, 28):02d} {random.randrange(24):02d}:00"
        until = f"2024-01-{random.randrange(1, 28):02d} 00:00" if random.random() < 0.8 else None
        user = "hot" if i % 3 else random.choice("ab")
        data.append((user, random.choice("cu"), at, i, until))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_cutting_a_hot_key_changes_nothing(spark, products, seed):
    log = events(spark, random_events(seed))
    plain = cancellation_timeline(log, products, segment=F.lit(0))
    cut = cancellation_timeline(log, products, segment=F.to_date("created_at"))
    assert bag(plain) == bag(cut)


def test_a_key_hot_within_one_day_is_cut_by_the_hour(spark, products):
    data = [(u, p, f"2024-01-05 {i % 24:02d}:00", i, until) for i, (u, p, _, _, until) in enumerate(random_events(4))]
    log = events(spark, data)
    by_hour = cancellation_timeline(log, products, segment=F.date_trunc("hour", "created_at"))
    assert bag(by_hour) == bag(cancellation_timeline(log, products, segment=F.lit(0)))


def test_no_job_runs_before_the_timeline_is_asked_for(spark, products):
    log = events(spark, random_events(5))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("timeline", "building the plan")
    cancellation_timeline(log, products)
    assert not tracker.getJobIdsForGroup("timeline")


def plain_timeline(data):
    """{user: [(created, cancelled_at, uncancelled_at, valid_from, next created)]} by reading one event after the other."""
    found = {}
    for user in {d[0] for d in data}:
        log = sorted((ts(at), v, t, ts(c)) for u, t, at, v, c, *_ in data if u == user)
        runs = []
        for at, v, t, c in log:
            if not runs or runs[-1][0] != t:
                runs.append((t, []))
            runs[-1][1].append((at, v, c))
        ends = []
        for t, run in runs:
            newest = max(at for at, _, _ in run)
            ends.append((t, *min((v, c) for at, v, c in run if at == newest)[1:], newest))
        pairs = []
        for k, (t, c, at) in enumerate(ends):
            end = ends[k + 1][2] if k + 1 < len(ends) else None
            if t == "c" and (c is None or end is None or c < end):
                pairs.append((at, c, end))
        made = []
        for k, (at, c, end) in enumerate(pairs):
            before = pairs[k - 1][2] if k else None
            holds = c is not None and (k == 0 or (before is not None and c > before))
            valid = before if k else ts("1900-01-01 00:00")
            made.append((at, c if holds else at, end, valid, pairs[k + 1][0] if k + 1 < len(pairs) else None))
        found[user] = made
    return found


def timed_events(seed, n, days, types):
    """Long runs of one type, ties in time and dates before and after the events."""
    draw = random.Random(seed)
    data, at = [], 0
    for i in range(n):
        at += draw.choice([0, 0, 1, 7, 30])
        kind = draw.choice(types) if draw.random() < 0.3 or not data else data[-1][1]
        until = at + draw.randrange(-60, 90)
        until = f"2024-{1 + until // 24 // 28 % 12:02d}-{1 + until // 24 % 28:02d} {until % 24:02d}:00" if draw.random() < 0.8 and until >= 0 else None
        hour = at % (24 * days)
        data.append((f"u{i * 3 // n}", kind, f"2024-{1 + hour // 24 // 28:02d}-{1 + hour // 24 % 28:02d} {hour % 24:02d}:00", draw.randrange(1000) * n + i, until))
    return data


@pytest.mark.parametrize("days", [1, 40, 300])
@pytest.mark.parametrize("types", ["cu", "cccu", "cuuu", "c", "u"])
def test_segments_carry_open_runs(spark, products, days, types):
    """Against a reading of the log one event after the other, for segments shorter and longer than runs."""
    data = timed_events(days, 180, days, types)
    log, expected = events(spark, data), plain_timeline(data)
    for segment in (None, F.date_trunc("hour", "created_at"), F.month("created_at"), F.lit(0)):
        found = {u: [] for u in expected}
        for r in rows(cancellation_timeline(log, products, segment), "admin_user_id", "cancellation_created_at"):
            found[r["admin_user_id"]].append((
                r["cancellation_created_at"], r["cancelled_at"], r["uncancelled_at"], r["valid_from"], r["next_cancellation_created_at"],
            ))
        assert found == expected


def test_null_users_and_times(spark, products):
    data = [(None, "c", "2024-01-01 10:00", 1, None), (None, "u", "2024-01-03 10:00", 2, None), ("a", "c", None, 1, None), ("a", "u", "2024-01-04 00:00", 2, None)]
    found = timeline(spark, products, data)
    assert [(r["admin_user_id"], r["uncancelled_at"]) for r in found] == [(None, ts("2024-01-03 10:00")), ("a", ts("2024-01-04 00:00"))]
    assert cancellation_timeline(events(spark, data).limit(0), products).count() == 0


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("Exchange hashpartitioning"), final.count("SortMergeJoin")


def test_events_are_shuffled_once(spark, products):
    """One shuffle of the events, one of the summaries by key, one back to the segments, and the product join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles, joins = exchanges(cancellation_timeline(events(spark, random_events(6)), products))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shuffles <= 6 and joins <= 2


def test_intervals_of_one_key_do_not_overlap(spark, products):
    found = timeline(spark, products, random_events(3))
    assert len(found) > 10
    for a, b in zip(found, found[1:]):
        if a["admin_user_id"] == b["admin_user_id"]:
            assert a["uncancelled_at"] is not None and a["uncancelled_at"] <= b["cancelled_at"]


def test_expand_days_counts_the_days_of_each_interval(spark):
    calendar = calendar_days(spark, day("2024-01-01"), day("2024-01-10"))
    df = spark.createDataFrame(
        [("closed", day("2024-01-03"), day("2024-01-05")), ("open", day("2024-01-09"), None),
         ("early", day("2023-12-30"), day("2024-01-02")), ("backwards", day("2024-01-05"), day("2024-01-03")),
         ("empty", day("2024-01-05"), day("2024-01-05")), ("outside", day("2024-02-01"), None), ("none", None, None)],
        "id string, a date, b date",
    )
    found = expand_days(df, "a", ["b"], calendar)
    assert bag(found, "id", "day_date") == [
        ("closed", day("2024-01-03")), ("closed", day("2024-01-04")), ("early", day("2024-01-01")),
        ("open", day("2024-01-09")), ("open", day("2024-01-10")),
    ]
    holes = calendar.filter("date != date'2024-01-04'")
    assert expand_days(df, "a", ["b"], holes).filter("id = 'closed'").count() == 1
    assert expand_days(df, "a", ["b"], calendar, last=F.lit(day("2024-01-09")), contiguous=True).filter("id = 'open'").count() == 1


def test_expansion_has_no_range_join(spark):
    calendar = calendar_days(spark, day("2024-01-01"), day("2024-01-10"))
    df = spark.createDataFrame([("x", day("2024-01-03"), day("2024-01-05"))], "id string, a date, b date")
    plan = spark._jvm.PythonSQLUtils.explainString(
        expand_days(df, "a", ["b"], calendar)._jdf.queryExecution(), "simple"
    )
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cancel_daily_pending_then_active(spark, products):
    line = cancellation_timeline(
        events(spark, [
            ("a", "c", "2024-01-02 20:00", 1, "2024-01-04 20:00", "Inactive System Cancel"),
            ("a", "u", "2024-01-06 20:00", 2, None),
        ]),
        products,
    )
    daily = rows(cancel_daily(line, calendar_days(spark, day("2024-01-01"), day("2024-01-10")), products), "day_date")
    assert [(r["day_date"].day, r["actively_cancelled"], r["cancelled_in_future"]) for r in daily] == [
        (2, False, True), (3, False, True), (4, True, False), (5, True, False),
    ]
    assert [r["is_autocancel"] for r in daily] == [0, 0, 1, 1]
    assert [r["future_cancel_is_autocancel"] for r in daily] == [1, 1, None, None]
    assert {r["protocol"] for r in daily} == {"proto"}


def brute_pauses(state, pauses):
    found = {}
    for uuid, d, start, following in state:
        past = [
            p for p in pauses
            if p[1] >= start and p[2] is not None
            and (p[2] < following if following else p[2] <= d) and p[3] <= d
        ]
        future = [p for p in pauses if p[1] > d and (p[2] is None or p[2] > d) and p[3] <= d]
        found[(uuid, d)] = (max((p[0] for p in past), default=None), min((p[0] for p in future), default=None))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_pauses_against_brute_force(spark, seed):
    random.seed(seed)
    dates = [day(f"2024-01-{i:02d}") for i in range(1, 29)]
    pauses = []
    for _ in range(15):
        created = random.randrange(0, 24)
        begins = min(27, max(0, created + random.randrange(-3, 8)))
        ends = random.choice([None, min(27, begins + random.randrange(1, 6)), max(0, begins - 1)])
        pauses.append((ts(f"{dates[begins]} {random.randrange(24):02d}:00"), dates[begins],
                       None if ends is None else dates[ends], dates[created]))
    state = [("s1", d, dates[2], dates[14]) for d in dates[2:14]] + [("s2", d, dates[14], None) for d in dates[14:]]
    df = spark.createDataFrame(
        [(u, "a", "p", d, s, n) for u, d, s, n in state],
        "uuid string, admin_user_id string, protocol string, date_day date, start_date_pst date, next_start_date_pst date",
    )
    log = spark.createDataFrame(
        [("a", "p", *p) for p in pauses],
        "admin_user_id string, protocol string, paused_at timestamp, paused_date_pst date, resumed_date_pst date, created_dt_pst date",
    )
    found = nearest_pauses(df, log, calendar_days(spark, dates[0], dates[-1]))
    assert {(r.uuid, r.date_day): (r.past_paused_at, r.future_paused_at) for r in found.collect()} == brute_pauses(state, pauses)

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import bag, day
from tidemark.operators.keys import latest_per_key, left_join, number_rows
from tidemark.operators.sequences import with_neighbours, with_running
from tidemark.operators.streaks import status_streaks


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one key is null, some segments are empty."""
    random.seed(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 else random.choice(["a", "b", None])
        data.append((key, i, random.randrange(100) if i % 5 else None, random.choice(["x", "y"])))
    return spark.createDataFrame(data, "key string, pos int, value int, kind string")


SEGMENTS = ["floor(pos / 50)", "floor(pos / 7)", "0"]


@pytest.mark.parametrize("segment", range(3))
def test_neighbours_equal_plain_window(skewed, segment):
    plain = Window.partitionBy("key").orderBy("pos")
    expected = skewed.select(
        "*", F.lag("value").over(plain).alias("p"), F.lag("kind").over(plain).alias("q"),
        F.lead("value").over(plain).alias("n"),
    )
    found = with_neighbours(
        skewed, ["key"], ["pos"], F.expr(SEGMENTS[segment]), {"p": "value", "q": "kind"}, {"n": "value"}
    )
    assert bag(found, "key", "pos", "p", "q", "n") == bag(expected, "key", "pos", "p", "q", "n")


@pytest.mark.parametrize("segment", range(3))
def test_running_totals_equal_plain_window(skewed, segment):
    plain = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    value = F.col("value")
    names = {"s": ("sum", value), "c": ("count", value), "hi": ("max", value), "lo": ("min", value)}
    expected = skewed.select(
        "key", "pos", F.sum(value).over(plain).alias("s"), F.count(value).over(plain).alias("c"),
        F.max(value).over(plain).alias("hi"), F.min(value).over(plain).alias("lo"),
    )
    found = with_running(skewed, ["key"], ["pos"], F.expr(SEGMENTS[segment]), names)
    columns = ["key", "pos", "s", "c", "hi", "lo"]
    assert bag(found, *columns) == bag(expected, *columns)


def test_number_rows_is_the_order_of_digests(spark, skewed):
    numbered = number_rows(skewed, ["pos"], buckets=16)
    expected = skewed.withColumn(
        "row_nbr", F.row_number().over(Window.orderBy(F.md5(F.col("pos").cast("string")), "pos"))
    )
    assert bag(numbered, "pos", "row_nbr") == bag(expected, "pos", "row_nbr")


def test_left_join_spreads_missing_keys_without_changing_rows(spark):
    left = spark.createDataFrame([(i, None if i % 2 else i) for i in range(40)], "id int, k int")
    right = spark.createDataFrame([(0, "zero"), (2, "two"), (2, "too"), (None, "never")], "k int, name string")
    found = left_join(left, right, {"k": "k"}, ["id"])
    expected = left.join(right, "k", "left").select("id", "k", "name")
    assert bag(found, "id", "k", "name") == bag(expected)
    plan = left.sparkSession._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "_salt" in join, "the salt must be part of the join keys"


def test_latest_per_key_limits_before_the_shuffle(skewed):
    newest = latest_per_key(skewed, ["key"], [F.col("pos").desc()])
    plan = skewed.sparkSession._jvm.PythonSQLUtils.explainString(newest._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert newest.count() == 4


# --- streaks ---------------------------------------------------------------------

INVENTORY = [
    ("2024-04-29", "In Stock", 1),
    ("2024-05-06", "In Stock", 2),
    ("2024-05-20", "In Stock", 1),
    ("2024-05-27", "Low Stock", 1),
    ("2024-06-03", "Low Stock", 2),
    ("2024-06-10", "Out of Stock", 1),
    ("2024-06-17", "Out of Stock", 2),
    ("2024-06-24", "In Stock", 1),
]


@pytest.mark.parametrize("segment", [None, "month"])
def test_streaks_of_the_worked_example(spark, segment):
    df = spark.createDataFrame(
        [("CENT001", 441562, day(w), s) for w, s, _ in INVENTORY],
        "distribution_center string, product_id long, report_week date, availability_status string",
    )
    cut = None if segment is None else F.trunc("report_week", segment)
    found = status_streaks(
        df, ["distribution_center", "product_id"], "report_week", "availability_status", segment=cut
    ).orderBy("report_week").collect()
    assert [r.consecutive_weeks_in_status for r in found] == [n for _, _, n in INVENTORY]
    assert [r.has_date_gap_flag for r in found] == [None, None, 1, None, None, None, None, None]
    assert [r.has_different_status_flag for r in found] == [None, None, None, 1, None, 1, None, 1]
    assert [r.week_grp for r in found] == [None, None, 1, 1, 1, 1, 1, 1]
    assert [r.availability_status_grp for r in found] == [None, None, None, 1, 1, 2, 2, 3]


def test_null_status_ends_no_streak(spark):
    weeks = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]
    df = spark.createDataFrame(
        [("a", day(w), s) for w, s in zip(weeks, ["x", None, "y", "z"])], "k string, w date, s string"
    )
    found = status_streaks(df, ["k"], "w", "s").orderBy("w").collect()
    assert [r.consecutive_weeks_in_status for r in found] == [1, 2, 3, 1]

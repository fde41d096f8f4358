import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, day, rows, ts
from tidemark.operators import scoring as sc

INTAKES = "uuid string, goals_freeform string, protocol string, new_refill string, intake_completed_at timestamp"
REQUESTS = "batch_id long, position int, uuid string, goals_freeform string, protocol string, is_new boolean"


def run_ts():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def scores(uuid, **given):
    return json.dumps({"uuid": uuid, **{c: None for c in sc.CATEGORIES}, **given})


def parse(spark, responses, *requests):
    asked = spark.createDataFrame([(b, i + 1, u, f"text {u}", "p", True) for i, (b, u) in enumerate(requests)], REQUESTS)
    answers = spark.createDataFrame(list(enumerate(responses)), "batch_id long, response string")
    parsed = sc.parse_scores(answers, asked, run_ts(), "m")
    return parsed, asked


def test_unscored_filters(spark):
    source = spark.createDataFrame(
        [
            ("a", "text", "p", "New", ts("2024-01-01 00:00")), ("b", "", "p", "New", ts("2024-01-01 00:00")),
            ("c", None, "p", None, ts("2024-01-01 00:00")), ("d", "text", "p", None, ts("2023-12-31 23:59")),
            ("e", "text", "p", "Refill", ts("2024-05-01 00:00")), ("f", "text", "p", None, ts("2024-05-01 00:00")),
        ],
        INTAKES,
    )
    scored = spark.createDataFrame([("e",), (None,)], "uuid string")
    found = sc.unscored(source, scored)
    assert bag(found, "uuid", "is_new") == [("a", True), ("f", False)]
    assert sc.unscored(source, scored, limit=1).count() == 1
    assert sc.unscored(source, scored, since=day("2023-01-01")).count() == 3


def test_batches_are_full_but_the_last_and_texts_keep_order(spark):
    requests = spark.range(45).select(
        F.col("id").cast("string").alias("uuid"), F.lit("t").alias("goals_freeform"), F.lit("p").alias("protocol"),
        F.lit(True).alias("is_new"),
    )
    numbered = sc.number_batches(requests)
    assert bag(numbered.groupBy("batch_id").count()) == [(0, 20), (1, 20), (2, 5)]
    batch = sc.batch_texts(numbered, "Begin\n", "End").filter("batch_id = 2").first()
    assert [r.position for r in batch.rows] == [1, 2, 3, 4, 5]
    assert batch.text.startswith("Begin\nRESPONSE 1\n") and batch.text.endswith("End")


@pytest.mark.parametrize(
    ("response", "expected"),
    [
        (scores("a", general=0), {"general": 0}),
        ("```json\n" + scores("a", strength=1, sex_drive=1) + "\n```", {"strength": 1, "sex_drive": 1}),
        (scores("a"), {}),
        ("text before\n   " + scores("a", diet=-1) + "  \r\ntext after", {"diet": -1}),
        (scores("a", diet=-1) + "\n" + scores("a", diet=1), {"diet": 1}),
        ("Result: " + json.dumps({"uuid": "a", "mood": 1, "why": {"x": 1}}, indent=1) + " done", {"mood": 1}),
        ('{"uuid": "a", "mood": "1", "diet": 1.5}', {"mood": 1}),
        ('{"uuid": "z", "mood": 0, "uuid": "a", "mood": 1}', {"mood": 1}),
    ],
)
def test_parsed(spark, response, expected):
    found = parse(spark, [response], (0, "a"))[0].collect()
    assert len(found) == 1 and found[0].batch_complete
    assert {c: found[0][c] for c in sc.CATEGORIES if found[0][c] is not None} == expected
    assert found[0].is_unscorable == (response == scores("a"))
    assert (found[0].goals_freeform, found[0].model_version) == ("text a", "m")


@pytest.mark.parametrize(
    "response",
    [None, "", "no json", "[1]", '{"uuid": "other"}', '{"uuid": "a"} {"uuid": "a"}', "{'uuid': 'a'}", '{"uuid": "a",}',
     '{"mood": 1}'],
)
def test_not_parsed_by_line(spark, response):
    found = parse(spark, [response], (0, "a"))[0].collect()
    # Two objects on one line are no line, but the search for objects finds them.
    assert len(found) == (1 if response and response.count("uuid") == 2 else 0)


def test_objects_are_searched_only_when_no_line_matches(spark):
    spread = json.dumps({"uuid": "b", "diet": 1}, indent=1)
    parsed, asked = parse(spark, [scores("a") + "\n" + spread], (0, "a"), (0, "b"))
    assert bag(parsed, "uuid", "batch_complete") == [("a", False)]
    assert sc.accepted(parsed).count() == 0
    assert sc.run_summary(asked, parsed).first().status == "failed"


def test_objects_longer_than_any_recursion(spark):
    long = json.dumps({"uuid": "a", "note": "x" * 200_000, "mood": 1}, indent=1)
    assert parse(spark, [long], (0, "a"))[0].first().mood == 1


def test_batches_are_all_or_nothing(spark):
    parsed, asked = parse(
        spark, [scores("a") + "\n" + scores("b"), scores("c")], (0, "a"), (0, "b"), (1, "c"), (1, "d")
    )
    assert bag(sc.accepted(parsed), "uuid") == [("a",), ("b",)]
    assert rows(sc.run_summary(asked, parsed)) == [
        {"status": "partial", "processed": 2, "written": 2, "failed": 2, "total": 4}
    ]


def test_whole_run_and_rerun(spark):
    source = spark.range(50).select(
        F.col("id").cast("string").alias("uuid"),
        F.concat(F.lit("answer "), "id").alias("goals_freeform"),
        F.lit("p").alias("protocol"),
        F.lit("New").alias("new_refill"),
        F.lit("2024-05-01 00:00:00").cast("timestamp").alias("intake_completed_at"),
    )
    scored = spark.createDataFrame([], sc.SCORED_SCHEMA)

    def scorer(text, batch):
        if any(r["uuid"] == "7" for r in batch):
            raise RuntimeError("service down")
        return "\n".join(json.dumps({"uuid": r["uuid"], "mood": len(r["goals_freeform"])}) for r in batch)

    parsed, asked, _ = sc.score_freeform(source, scored, scorer, run_ts(), "m")
    first = sc.cut_lineage(sc.accepted(parsed))
    summary = sc.run_summary(asked, parsed).first()
    assert first.schema.names == sc.SCORED_SCHEMA.names
    assert (summary.status, summary.total, summary.written + summary.failed) == ("partial", 50, 50)
    assert summary.failed in (10, 20) and first.count() == summary.written
    assert {r.mood for r in first.collect()} <= {8, 9}
    # The failed batch is what a second run finds.
    again, asked, _ = sc.score_freeform(source, first, lambda text, batch: "\n".join(
        json.dumps({"uuid": r["uuid"]}) for r in batch), run_ts(), "m")
    assert asked.count() == summary.failed and sc.accepted(again).count() == summary.failed
    assert {r.is_unscorable for r in again.collect()} == {True}
    assert sc.run_summary(asked.limit(0), again.limit(0)).first().status == "success"


def test_the_job_appends_complete_batches_and_asks_again_for_the_rest(spark, tmp_path):
    source = spark.createDataFrame(
        [(f"u{i}", "a text", "p", "New", ts("2024-02-01 00:00")) for i in range(5)],
        "uuid string, goals_freeform string, protocol string, new_refill string, intake_completed_at timestamp",
    )
    path = str(tmp_path / "scored")

    def scorer(text, batch):
        if any(r["uuid"] == "u1" for r in batch):
            raise ValueError("no answer")
        lines = "\n".join(scores(r["uuid"], anxiety=1) for r in batch)
        return lines, 2000 if any(r["uuid"] == "u2" for r in batch) else 5

    first = sc.score_into(path, source, scorer, run_ts(), "m", size=1, accept=sc.long_enough()).first()
    assert (first.status, first.written, first.failed, first.errors, first.tokens) == ("partial", 1, 4, 1, 2015)

    def second(text, batch):
        return "\n".join(scores(r["uuid"], anxiety=0) for r in batch), 1000

    again = sc.score_into(path, source, second, run_ts(), "m", size=1, accept=sc.long_enough()).first()
    assert (again.status, again.written, again.total, again.errors) == ("success", 4, 4, 0)
    table = spark.read.parquet(path)
    assert sorted(r.uuid for r in table.collect()) == [f"u{i}" for i in range(5)]
    assert sc.score_into(path, source, second, run_ts(), "m").first().total == 0


def test_repeated_and_missing_rows_of_a_batch(spark):
    """A row asked for twice is found once, so its batch stays incomplete; a null uuid is never found."""
    answer = scores("a", diet=1) + "\n" + scores("b") + "\n" + scores("z")
    parsed, _ = parse(spark, [answer, answer, None], (0, "a"), (0, "a"), (0, "b"), (1, "a"), (1, "b"), (2, "c"))
    found = bag(parsed, "batch_id", "uuid", "goals_freeform", "batch_complete")
    assert found == [(0, "a", "text a", False), (0, "b", "text b", False), (1, "a", "text a", True), (1, "b", "text b", True)]
    asked = spark.createDataFrame([(0, 1, None, "t", "p", True), (0, 2, "a", "t", "p", None)], REQUESTS)
    answers = spark.createDataFrame([(0, answer), (7, answer)], "batch_id long, response string")
    assert bag(sc.parse_scores(answers, asked, run_ts(), "m"), "uuid", "batch_complete") == [("a", False)]
    assert sc.parse_scores(answers.limit(0), asked, run_ts(), "m").count() == 0


def test_parsing_meets_the_rows_once(spark):
    requests = spark.range(200).select(
        F.col("id").cast("string").alias("uuid"), F.lit("t").alias("goals_freeform"), F.lit("p").alias("protocol"), F.lit(True).alias("is_new")
    )
    asked = sc.cut_lineage(sc.number_batches(requests))
    answers = sc.cut_lineage(asked.groupBy("batch_id").agg(F.array_join(F.collect_list(F.format_string('{"uuid": "%s", "mood": 1}', "uuid")), "\n").alias("response")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parsed = sc.parse_scores(answers, asked, run_ts(), "m")
        assert parsed.filter("batch_complete and mood = 1").count() == 200
        parsed.collect()
        plan = parsed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") <= 2



def test_a_worker_holds_one_batch_at_a_time(spark):
    def held(_text, _rows):
        with open("/proc/self/statm") as f:
            return str(int(f.read().split()[1]) * 4096)

    row = "array(named_struct('position', 1, 'uuid', 'u', 'goals_freeform', 'g', 'protocol', 'p', 'is_new', true))"
    batches = spark.range(200).coalesce(1).selectExpr("id AS batch_id", f"{row} AS rows", "repeat('x', 3000000) AS text")
    # Where the session does not bound an Arrow batch by its bytes, the scorer's batches still come one by one.
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(bound, str(2**31 - 1))
    try:
        found = sc.run_scorer(batches, held).collect()
    finally:
        spark.conf.unset(bound)
    assert len(found) == 200
    assert max(int(r.response) for r in found) < 500_000_000

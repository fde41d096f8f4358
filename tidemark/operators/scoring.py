"""Batched scoring of free text with a scorer handed in by the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import exists
from tidemark.operators.keys import number_rows
from tidemark.session import cut_lineage
from tidemark.sources.tables import append_rows, read_or_empty

# The seventeen score columns.
CATEGORIES = (
    "anxiety",
    "diet",
    "focus",
    "energy",
    "mood",
    "mental_clarity",
    "sleep",
    "weight_loss",
    "skin",
    "strength",
    "sex_drive",
    "confidence",
    "relaxation",
    "erectile_function",
    "hair_growth",
    "exercise",
    "general",
)
BATCH_SIZE = 20
SCORED_SINCE = dt.date(2024, 1, 1)

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("uuid", T.StringType(), False),
        T.StructField("goals_freeform", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("is_new", T.BooleanType()),
        T.StructField("scored_at", T.TimestampType(), False),
        T.StructField("model_version", T.StringType()),
        T.StructField("is_unscorable", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in CATEGORIES],
    ]
)

# A scorer gets the batch as text and as rows and returns the raw response text, or
# the text and the number of tokens it was written with.
Scorer = Callable[[str, list[dict]], str | tuple[str, int]]

# Fixed value: a response of fewer tokens counts as cut off.
LEAST_TOKENS = 1000

# An object with at most one level of objects inside, written so that the
# matcher loops per inner object and not per character.
_OBJECT = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"


def unscored(
    source: DataFrame, scored: DataFrame, since: dt.date = SCORED_SINCE, limit: int | None = None
) -> DataFrame:
    """Texts that are not empty, recent enough and not scored yet.

    ``limit`` takes that many rows in a fixed order; it is applied by row number,
    not by bringing the rows together.
    """
    waiting = (
        source.filter(F.coalesce("goals_freeform", F.lit("")) != "")
        .filter(F.to_date("intake_completed_at") >= F.lit(since))
        .select("uuid", "goals_freeform", "protocol", exists(F.col("new_refill") == "New").alias("is_new"))
        .join(scored.select("uuid"), "uuid", "left_anti")
    )
    if limit is None:
        return waiting
    return number_rows(waiting, ["uuid"]).filter(F.col("row_nbr") <= limit).drop("row_nbr")


def number_batches(requests: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_id`` and ``position`` (from 1); every batch but the last is full."""
    place = F.col("row_nbr") - 1
    return (
        number_rows(requests, ["uuid"])
        .withColumn("batch_id", F.floor(place / size).cast("bigint"))
        .withColumn("position", (place % size + 1).cast("int"))
        .drop("row_nbr")
    )


def batch_texts(numbered: DataFrame, heading: str = "", closing: str = "") -> DataFrame:
    """One row per batch: its rows in order and the text that presents them."""
    item = F.struct("position", "uuid", "goals_freeform", "protocol", "is_new")

    def block(row: Column) -> Column:
        shown = [F.coalesce(row[c].cast("string"), F.lit("None")) for c in ("uuid", "protocol", "is_new", "goals_freeform")]
        return F.format_string("RESPONSE %d\nUUID: %s\nProtocol: %s\nNew: %s\nText: %s\n", row["position"], *shown)

    return (
        numbered.groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(item)).alias("rows"))
        .withColumn(
            "text",
            F.concat(F.lit(heading), F.array_join(F.transform("rows", block), "\n"), F.lit(closing)),
        )
    )


def long_enough(least: int = LEAST_TOKENS) -> Column:
    """Keeps responses with text and, where the scorer counts tokens, enough of them."""
    counted = F.col("tokens").isNull() | (F.col("tokens") >= least)
    return (F.trim(F.coalesce("response", F.lit(""))) != "") & counted


def run_scorer(batches: DataFrame, scorer: Scorer) -> DataFrame:
    """Call the scorer once per batch: (batch_id, response, tokens, error).

    A batch it fails on gets no response but the error's text. Batches are handed to Python
    one by one, so a worker holds the texts of one of them, however many there are.
    """

    def respond(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for batch, text, rows in zip(frame["batch_id"], frame["text"], frame["rows"], strict=True):
            try:
                answer = scorer(text, [r if isinstance(r, dict) else r.asDict() for r in rows])
                response, tokens = answer if isinstance(answer, tuple) else (answer, None)
                found.append((batch, response, tokens, None))
            except Exception as error:  # noqa: BLE001 - any failure leaves the batch for the next run
                found.append((batch, None, None, f"{type(error).__name__}: {error}"))
        made = pd.DataFrame(found, columns=["batch_id", "response", "tokens", "error"])
        return made.astype({"batch_id": "int64", "response": object, "tokens": "Int64", "error": object})

    schema = "batch_id bigint, response string, tokens bigint, error string"
    return batches.groupBy("batch_id").applyInPandas(respond, schema)


def _objects(text: Column) -> Column:
    """JSON object as a list of one map of texts; empty for anything else.

    Parsed as the only element of an array, which rejects text after the object.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"}
    )
    return F.flatten(F.filter(F.array(parsed), lambda found: F.size(found) == 1))


def _value(found: Column, key: str) -> Column:
    """Value of a key of a parsed object; of a repeated key, the last one."""
    values = F.map_values(F.map_filter(found, lambda name, _: name == key))
    return F.try_element_at(values, F.lit(-1))


def _named(texts: Column, uuids: Column) -> Column:
    """Of texts that are JSON objects, those that name one of ``uuids``, in order: (uuid, object)."""
    objects = F.flatten(F.transform(texts, _objects))
    named = F.transform(objects, lambda found: F.struct(_value(found, "uuid").alias("uuid"), found.alias("object")))
    return F.filter(named, lambda found: F.array_contains(uuids, found["uuid"]))


def parse_scores(
    responses: DataFrame,
    requests: DataFrame,
    run_ts: Column,
    model_version: str,
    accept: Column | None = None,
) -> DataFrame:
    """Parsed scores with the request's own columns and ``batch_complete``.

    ``responses``: ``batch_id``, ``response``, one row per batch; ``requests``: numbered
    rows. Lines are tried first; only a response in which no line names one of its rows is
    searched for objects anywhere in the text. Of several objects for a row the last counts,
    of several rows with one uuid the first; a batch is complete when every row was found.
    ``accept`` rejects responses before they are read.

    A batch meets its rows once and is parsed inside its own row, which is bounded by the
    batch size and the response; only the found rows come out of it.
    """
    kept = responses if accept is None else responses.filter(accept)
    row = F.struct("position", "uuid", "goals_freeform", "protocol", "is_new")
    asked = requests.groupBy("batch_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    unfenced = F.regexp_replace(F.regexp_replace("response", "```json\\s*", ""), "```\\s*", "")
    batches = (
        kept.select("batch_id", unfenced.alias("content"))
        .join(asked, "batch_id")
        .withColumn("uuids", F.transform("rows", lambda r: r["uuid"]))
    )

    trimmed = F.transform(F.split("content", "\n"), lambda line: F.regexp_replace(line, r"^\s+|\s+$", ""))
    lines = F.filter(trimmed, lambda line: line.startswith("{"))
    anywhere = F.regexp_extract_all("content", F.lit(_OBJECT), F.lit(0))
    # Columns of their own: each is used more than once and so is not worked out again.
    batches = batches.withColumn("by_line", _named(lines, F.col("uuids")))
    batches = batches.withColumn(
        "found", F.when(F.size("by_line") > 0, F.col("by_line")).otherwise(_named(anywhere, F.col("uuids")))
    )
    firsts = F.filter("rows", lambda r, i: F.array_position("uuids", r["uuid"]) == i + 1)
    answered = F.transform(
        firsts,
        lambda r: F.struct(
            r.alias("row"),
            F.try_element_at(F.filter("found", lambda f: f["uuid"] == r["uuid"]), F.lit(-1))["object"].alias("object"),
        ),
    )
    batches = batches.withColumn("answered", F.filter(answered, lambda a: a["object"].isNotNull()))
    complete = F.size("answered") == F.size("rows")
    # An outer explode: the plain one would work out its list again in a filter below itself.
    parsed = (
        batches.select("batch_id", complete.alias("batch_complete"), F.explode_outer("answered").alias("a"))
        .filter(F.col("a").isNotNull())
        .select("batch_id", "batch_complete", "a.row.*", "a.object")
    )
    scores = [_value(F.col("object"), c) for c in CATEGORIES]
    return parsed.select(
        "batch_id",
        "batch_complete",
        "uuid",
        "goals_freeform",
        "protocol",
        "is_new",
        run_ts.alias("scored_at"),
        F.lit(model_version).alias("model_version"),
        F.coalesce(*scores).isNull().alias("is_unscorable"),
        *[s.try_cast("bigint").alias(c) for s, c in zip(scores, CATEGORIES, strict=True)],
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows to append: those of complete batches. The rest stays unscored."""
    return parsed.filter("batch_complete").select(*SCORED_SCHEMA.names)


def run_summary(requests: DataFrame, parsed: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """One row: how many rows were asked for, written and failed, and the status.

    With the scorer's ``responses`` also ``errors``, the batches it failed on, and
    ``tokens``, what it wrote in all.
    """
    asked = requests.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = parsed.agg(F.coalesce(F.count_if("batch_complete"), F.lit(0)).alias("written"))
    written, failed = F.col("written"), F.col("failed")
    return (
        counts.withColumn("total", asked)
        .withColumn("failed", F.col("total") - written)
        .withColumn("processed", written)
        .withColumn(
            "status",
            F.when(failed == 0, "success").when(written > 0, "partial").otherwise("failed"),
        )
        .select("status", "processed", "written", "failed", "total", *_usage(responses))
    )


def _usage(responses: DataFrame | None) -> list[Column]:
    if responses is None:
        return []
    count = responses.agg(F.count("error").alias("n")).scalar()
    tokens = responses.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).scalar()
    return [count.alias("errors"), tokens.alias("tokens")]


def score_freeform(
    source: DataFrame,
    scored: DataFrame,
    scorer: Scorer,
    run_ts: Column,
    model_version: str,
    size: int = BATCH_SIZE,
    since: dt.date = SCORED_SINCE,
    limit: int | None = None,
    accept: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parsed scores, numbered requests, responses) for everything not scored yet.

    ``accept``, for example ``long_enough()``, rejects responses before they are read.

    Responses are written once before they are parsed: the scorer is an outside
    call and must not be repeated by a second reader or a lost executor.
    """
    requests = cut_lineage(number_batches(unscored(source, scored, since, limit), size))
    responses = cut_lineage(run_scorer(batch_texts(requests), scorer))
    return parse_scores(responses, requests, run_ts, model_version, accept), requests, responses


def score_into(
    path: str, source: DataFrame, scorer: Scorer, run_ts: Column, model_version: str, **options
) -> DataFrame:
    """One run of the scoring job: score what ``path`` lacks, append what is complete, return the summary.

    Rows of batches that failed are not in the table and so are asked again by the
    next run. ``options`` are those of ``score_freeform``.
    """
    spark = source.sparkSession
    scored = read_or_empty(spark, path, SCORED_SCHEMA)
    parsed, requests, responses = score_freeform(source, scored, scorer, run_ts, model_version, **options)
    parsed = cut_lineage(parsed)
    summary = run_summary(requests, parsed, responses)
    written = accepted(parsed)
    if not written.isEmpty():
        append_rows(written, path)
    return summary

"""Quality rules over lines: base counts of a text and cross-document line frequency.

DataFrame functions only. Everything about one text is computed inside its row
with array functions; only hashes of lines, never texts, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_GAP, fresh, with_let
from tidemark.session import cut_lineage

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words that stand in a three-word window which the text has at least twice.

    Windows are sorted by hash; those equal to a neighbour repeat, and each of
    them, in order of place, covers three words or as many as up to the next one.
    """
    n = F.size(words)
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")
        ),
    )
    repeated = with_let(
        F.sort_array(windows),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["at"],
            )
        ),
    )
    return with_let(
        repeated,
        lambda at: F.aggregate(
            F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        ),
    )


def _even(text: Column) -> Column:
    even = F.translate(text, UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(even, r"[\x20\x09\x0B-\x0D]+", " ")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(row, doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines, body) per input row.

    ``lines`` has for every line with a word the hash of its normalised form (A-Z
    lowered, digits to 0, blanks to one) and its number of words, ``body`` is a
    hash of the text. ``row`` is only unique within one run: write the frame before it is used twice.
    """
    given = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    solid = F.length(F.translate(text, BLANKS, ""))
    raw_lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    lines = F.filter(F.transform(F.split(_even(text), "\n"), lambda line: F.trim(line)), lambda line: line != "")
    in_words = with_let(
        _words(text),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeat_words(w).alias("n_repeat_words")),
    )
    made = given.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "host",
        in_words.alias("w"),
        solid.cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        with_let(raw_lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        F.transform(
            lines,
            lambda line: F.struct(
                F.xxhash64(line).alias("h"),
                (F.length(line) - F.length(F.translate(line, " ", "")) + 1).alias("n"),
            ),
        ).alias("lines"),
        F.xxhash64(text).alias("body"),
    )
    return made.select(
        "row", "doc_id", "host", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "lines", "body"
    )


def frequent_lines(measured: DataFrame, most_docs: int, most_share: float, fewest: int | None = None) -> DataFrame:
    """(host, h): lines in more than ``most_docs`` documents and ``most_share`` of all documents of their host.

    With ``fewest``, passing one of the two limits is enough for a line in more than so many
    documents: the share judges small hosts and the number large ones.

    A document is counted once per line however often its id or the line occurs;
    a row without an id is a document of its own. Counting is by keys of (host,
    line, document) with map-side partial sums, so neither a host nor a line with
    a third of all rows gathers in one task.
    """
    who = [F.coalesce("doc_id", F.lit(0)).alias("d"), F.when(F.col("doc_id").isNull(), F.col("row")).alias("r")]
    seen = measured.select(
        "host", *who, F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h")
    )
    least = most_docs if fewest is None else fewest
    n_docs = seen.distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > least)
    sizes = measured.select("host", *who).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    same = n_docs["host"].eqNullSafe(sizes["host"])
    over = F.col("n_docs") > most_share * F.col("host_docs")
    if fewest is not None:
        over = over | (F.col("n_docs") > most_docs)
    return n_docs.join(sizes, same).filter(over).select(n_docs["host"], "h")


def _lines_out(measured: DataFrame, frequent: DataFrame) -> DataFrame:
    """(row, n_boilerplate, gone): words in frequent lines and the hashes of those lines, for rows that have any."""
    lines = measured.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.h", "line.n")
    return (
        lines.join(frequent, lines["host"].eqNullSafe(frequent["host"]) & (lines["h"] == frequent["h"]))
        .groupBy("row")
        .agg(F.sum("n").alias("n_boilerplate"), F.collect_set(lines["h"]).alias("gone"))
    )


def drop_frequent_lines(
    docs: DataFrame,
    most_docs: int = 50,
    most_share: float = 0.02,
    least_left: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    fewest: int | None = None,
) -> DataFrame:
    """``docs``, all columns, without the frequent lines of their host and without depleted rows.

    A row is depleted if less than ``least_left`` of its words are left. Limits are those of
    ``frequent_lines``; the base rules of ``line_quality`` are not applied. Rows join the
    hashes of their own frequent lines by id, host and a hash of the text. Null and empty
    texts have no lines and stay as they are; a null host is a host of its own; repeated
    rows are one document and go or stay together; an empty table gives no rows.
    """
    measured = cut_lineage(measures(docs, id_col, text_col, host_col))
    out = _lines_out(measured, frequent_lines(measured, most_docs, most_share, fewest))
    number, host, body, gone, enough = fresh(docs, "gone_id", "gone_host", "gone_body", "gone_lines", "enough_left")
    left = F.col("n_words") - F.col("n_boilerplate")
    marks = (
        measured.join(out, "row")
        .groupBy(F.col("doc_id").alias(number), F.col("host").alias(host), F.col("body").alias(body))
        .agg(F.first("gone").alias(gone), F.first(left >= least_left * F.col("n_words")).alias(enough))
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.join(
        marks,
        F.col(id_col).cast("bigint").eqNullSafe(F.col(number))
        & F.col(host_col).cast("string").eqNullSafe(F.col(host))
        & (F.xxhash64(text) == F.col(body)),
        "left",
    )
    kept = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(F.col(gone), F.xxhash64(F.trim(_even(line)))))
    shown = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.concat_ws("\n", kept))
    return joined.filter(F.coalesce(F.col(enough), F.lit(True))).select(
        *[shown.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    )


def line_quality(
    docs: DataFrame,
    most_docs: int = 50,
    most_share: float = 0.02,
    least_left: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    fewest: int | None = None,
) -> DataFrame:
    """Base counts, base verdict and the verdict of line frequency for every row of ``docs``.

    Lines that are too frequent in their host (see ``frequent_lines``) are taken out; a document of which
    less than ``least_left`` of the words is left is rejected, as is one that fails
    the base rules (fewer than 50 words, or more than half of them in repeated
    three-word windows). Null and empty texts have zero counts and fail. A null
    host is a host of its own. Repeated rows are judged alike, each for itself.
    """
    measured = cut_lineage(measures(docs, id_col, text_col, host_col))
    frequent = frequent_lines(measured, most_docs, most_share, fewest)
    out = _lines_out(measured, frequent).select("row", "n_boilerplate")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_boilerplate")
    return (
        measured.drop("lines", "body")
        .join(out, "row", "left")
        .fillna(0, ["n_boilerplate"])
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
            "n_boilerplate",
        )
    )


def line_quality_sql(most_docs: int = 50, most_share: float = 0.02, least_left: float = 0.5, fewest: int | None = None) -> str:
    """The same verdicts for DuckDB, with whole lines and windows in place of hashes."""
    share = f"{most_share} * docs"
    limit = f"greatest({most_docs}, {share})" if fewest is None else f"greatest({fewest}, least({most_docs}, {share}))"
    blanks = r"[\x20\x09-\x0D]"
    return rf"""
WITH given AS (
  SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT *, [w for w in regexp_split_to_array(text, '{blanks}+') if w <> ''] AS words,
    [l for l in string_split(text, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS raw_lines,
    [trim(l, ' ') for l in string_split(regexp_replace(translate(text, '{UPPER}123456789', '{LOWER}000000000'),
      '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)) if trim(l, ' ') <> ''] AS lines
  FROM given
), windows AS (
  SELECT row, unnest(range(1, len(words) - 1)) AS start, unnest([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]
    for i in range(1, len(words) - 1)]) AS w
  FROM parts WHERE len(words) >= 3
), doubled AS (
  SELECT row, start FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1
), covered AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest([start, start + 1, start + 2]) AS place FROM doubled) GROUP BY row
), lines AS (
  SELECT row, doc_id, host, unnest(lines) AS line FROM parts
), sizes AS (
  SELECT host, count(DISTINCT coalesce('d' || doc_id, 'r' || row)) AS docs FROM given GROUP BY host
), frequent AS (
  SELECT lines.host, line FROM lines JOIN sizes ON lines.host IS NOT DISTINCT FROM sizes.host GROUP BY lines.host, line, docs
  HAVING count(DISTINCT coalesce('d' || doc_id, 'r' || row)) > {limit}
), gone AS (
  SELECT row, sum(len(string_split(lines.line, ' '))) AS n
  FROM lines JOIN frequent ON lines.line = frequent.line AND lines.host IS NOT DISTINCT FROM frequent.host GROUP BY row
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '{blanks}', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
    len(raw_lines) - len(list_distinct(raw_lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    cast(coalesce(gone.n, 0) AS BIGINT) AS n_boilerplate
  FROM parts LEFT JOIN covered USING (row) LEFT JOIN gone USING (row)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND n_words - n_boilerplate >= {least_left} * n_words AS kept FROM judged
"""

"""License scans: canonical digests of whole texts and lines, joined to known licences.

DataFrame functions only. A text is lowered, its copyright lines are dropped,
everything but letters and digits becomes one blank and equivalent spellings
become one; the digest of what is left is looked up among those of known texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_texts import EQUIVALENT, KNOWN
from tidemark.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that states a copyright; it starts at the line feed before it.
COPYRIGHT_LINE = (
    r"\n[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
)
#: What parts words: ASCII other than lower letters and digits, and typographic marks.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F©“”‘’–—]+"
#: Known texts that may be broadcast; more would be a table to be joined by Spark's own choice.
MOST_KNOWN = 10_000


def without_copyright(text: Column) -> Column:
    """Lowered text without its copyright lines; one line feed stands before the first line."""
    return F.regexp_replace(F.concat(F.lit("\n"), F.translate(text, UPPER, LOWER)), COPYRIGHT_LINE, "\n")


def canonical(plain: Column) -> Column:
    words = F.trim(F.regexp_replace(plain, NOT_WORD, " "))
    for spelling, usual in EQUIVALENT:
        words = F.replace(words, F.lit(spelling), F.lit(usual))
    return words


def digest(words: Column) -> Column:
    """SHA-256 of a canonical text, null if it has no words."""
    return F.when(words != "", F.sha2(words, 256))


def scan(
    docs: DataFrame,
    known: Sequence[tuple[str, str]] = KNOWN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, digest, license, n_license_lines, line_licenses) of every row of ``docs``.

    ``license`` names the known text that the whole document equals after
    normalisation; ``line_licenses`` those that one of its lines equals, in order,
    comma-joined (empty if none). Null and empty texts have a null digest. Repeated
    rows and null ids come out row by row. Where known texts have one digest, the
    first name in order counts. Only lines that match are ever shuffled.
    """
    if len(known) > MOST_KNOWN:
        raise ValueError(f"at most {MOST_KNOWN} known texts")
    plain = without_copyright(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    units = cut_lineage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("bigint").alias("doc_id"),
            digest(canonical(plain)).alias("digest"),
            F.transform(
                F.filter(F.split(plain, "\n"), lambda x: F.length(x) > 1), lambda line: digest(canonical(line))
            ).alias("lines"),
        )
    )
    spark = docs.sparkSession
    texts = spark.createDataFrame(list(known), "license string, text string")
    names = F.broadcast(
        texts.select("license", digest(canonical(without_copyright(F.col("text")))).alias("known"))
        .groupBy("known")
        .agg(F.min("license").alias("license"))
    )
    whole = units.join(names, units["digest"] == names["known"], "left").select("row", "doc_id", "digest", "license")
    lines = (
        units.select("row", F.explode("lines").alias("line"))
        .join(names, F.col("line") == F.col("known"))
        .groupBy("row")
        .agg(
            F.count(F.lit(1)).alias("n_license_lines"),
            F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("line_licenses"),
        )
    )
    return (
        whole.join(lines, "row", "left")
        .drop("row")
        .fillna(0, ["n_license_lines"])
        .fillna("", ["line_licenses"])
    )


def scan_sql(known: Sequence[tuple[str, str]] = KNOWN, table: str = "documents") -> str:
    """The same scan for DuckDB."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    plain = f"regexp_replace(chr(10) || translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"

    def canon(of: str) -> str:
        made = f"trim(regexp_replace({of}, {quoted(NOT_WORD)}, ' ', 'g'), ' ')"
        for a, b in EQUIVALENT:
            made = f"replace({made}, {quoted(a)}, {quoted(b)})"
        return made

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known)
    return f"""
WITH known AS (
  SELECT min(license) AS license, sha256(words) AS known
  FROM (SELECT license, {canon(plain)} AS words FROM (VALUES {values}) AS t(license, text)) GROUP BY words
), plain AS (
  SELECT row_number() OVER () AS row, doc_id, {plain} AS plain FROM {table}
), whole AS (
  SELECT row, doc_id, CASE WHEN words <> '' THEN sha256(words) END AS digest
  FROM (SELECT row, doc_id, {canon("plain")} AS words FROM plain)
), lines AS (
  SELECT row, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM (SELECT row, {canon("line")} AS words FROM (SELECT row, unnest(string_split(plain, chr(10))) AS line FROM plain))
  JOIN known ON sha256(words) = known WHERE words <> '' GROUP BY row
)
SELECT doc_id, digest, license, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS line_licenses
FROM whole LEFT JOIN known ON digest = known LEFT JOIN lines USING (row)
"""

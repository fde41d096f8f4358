"""Frequent lines are taken out of the texts of their host."""

import os

import pytest
from pyspark.sql import functions as F

from tests import oracle_check
from tidemark.llm import line_rules, queries


def test_frequent_lines_leave_the_text_and_depleted_rows_go(frame):
    own = lambda i: " ".join(chr(97 + i % 26) + chr(97 + i // 26) + "q" * k for k in range(20))
    rows = [(i, f"Read  MORE 7\n{own(i)}\n\nread more 3") for i in range(8)]
    rows += [(20, "read more 1\nalone"), (21, None), (None, f"Read more 5\n{own(22)}")]
    docs = frame(rows, extra=True).withColumn("source", F.lit("a"))
    docs = docs.unionByName(frame([(30, f"read more 1\n{own(30)}")], extra=True).withColumn("source", F.lit("b")))
    found = line_rules.drop_frequent_lines(docs, most_docs=3, most_share=0.1)
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == {
        **{i: f"{own(i)}\n" for i in range(8)}, 21: None, None: own(22), 30: f"read more 1\n{own(30)}"
    }
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _own(i):
    name = chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676)
    return " ".join(name + chr(97 + k % 26) + "q" * (k // 26) for k in range(60))


def _hosts():
    """(id, text, host): lines in 3 to 90 documents of hosts of several sizes; digits would be normalised away."""
    rows = []
    for host, size, counts in (("small", 20, (3, 6, 12)), ("middle", 400, (5, 8, 9, 30)), ("hot", 4000, (45, 51, 60, 90)), (None, 10, (5, 6))):
        for k in range(size):
            lines = [f"banner {'x' * n} at {host}" for n in counts if k < n]
            rows.append((len(rows), "\n".join([_own(len(rows) + 7), *lines]), host))
    return rows


def test_limits_act_alike_on_small_and_hot_hosts(spark, tmp_path):
    rows = _hosts() + [(5000, None, "small"), (5001, "", None)] + _hosts()[:3]
    docs = spark.createDataFrame([(i, t, "en", h, 0) for i, t, h in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    flagged = {"small": {6, 12}, "middle": {9, 30}, "hot": {51, 60, 90}, None: {6}}  # over five and over 2 %, or over 50
    found = line_rules.drop_frequent_lines(docs, **queries.LINE_LIMITS)
    for r in found.collect():
        left = {len(line.split()[1]) for line in (r.text or "").split("\n") if line.startswith("banner")}
        assert not left & flagged[r.source]
    kept = {(r.source, len(line.split()[1])) for r in found.collect() for line in (r.text or "").split("\n") if line.startswith("banner")}
    assert kept == {("small", 3), ("middle", 5), ("middle", 8), ("hot", 45), (None, 5)}
    assert found.count() == len(rows), "rows of a banner and sixty words of their own stay; so do empty ones and repeats"
    assert line_rules.drop_frequent_lines(docs.limit(0), **queries.LINE_LIMITS).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert oracle_check.compare(spark, oracle_check.duckdb.connect(), "", lambda s, _: queries.op4_line_rules(s, str(tmp_path)), queries.ORACLE_SQL["op4_line_rules"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")) is None
    marked = queries.op4_line_rules(spark, str(tmp_path)).filter("n_boilerplate > 0").count()
    assert marked == 12 + 3 + 30 + 90 + 6  # documents with a flagged line; three of them are in the table twice


def test_limits_flag_lines_of_the_small_tables(spark):
    folder = oracle_check.DEFAULT_FOLDER.replace("0.001", "0.01")
    if not os.path.isdir(folder):
        pytest.skip("benchmark tables are not here")
    assert queries.op4_line_rules(spark, folder).filter("n_boilerplate > 0").count() > 0

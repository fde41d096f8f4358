"""The classifier on planted labels; the operators in plain DataFrame functions against their SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import made_texts
from tests.llm.test_against_plain import bag
from tidemark.llm import license_texts, licenses, line_rules, quality_model
from tidemark.llm.common import fold


def _plan(df):
    return df._jdf.queryExecution().toString()


def _by_sql(df, sql):
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    return con.sql(sql)


@pytest.mark.parametrize("rows", ["plain", "odd", "none"])
def test_line_rules_equal_their_sql(frame, request, rows):
    docs = frame([] if rows == "none" else request.getfixturevalue(rows), extra=True)
    found = line_rules.line_quality(docs, most_docs=2, most_share=0.1)
    names = sorted(found.columns)
    expected = _by_sql(docs, line_rules.line_quality_sql(2, 0.1)).select(", ".join(names)).fetchall()
    assert bag(found.select(*names).collect()) == bag(expected)
    if rows == "plain":
        assert any(r.n_boilerplate for r in found.collect())
    assert "Python" not in _plan(found) and "Arrow" not in _plan(found)


def test_line_rules_reject_depleted_documents(frame):
    words = [f"w{k}" for k in range(60)]
    shared = " ".join(words)
    rows = [(i, shared + "\n" + " ".join(f"{w}{i}" for w in words[: 20 + 5 * i])) for i in range(12)]
    found = {r.doc_id: r.kept for r in line_rules.line_quality(frame(rows).withColumn("source", F.lit("a")), 5, 0.5).collect()}
    assert [found[i] for i in range(12)] == [20 + 5 * i >= 40 + 0 * i and 20 + 5 * i >= (80 + 5 * i) / 2 for i in range(12)]


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_license_scan_equals_its_sql(frame, request, rows):
    docs = frame([] if rows == "none" else [*request.getfixturevalue(rows), *LICENSED], extra=True)
    found = licenses.scan(docs)
    names = sorted(found.columns)
    expected = _by_sql(docs, licenses.scan_sql()).select(", ".join(names)).fetchall()
    assert bag(found.select(*names).collect()) == bag(expected)
    assert "Python" not in _plan(found) and "Arrow" not in _plan(found)


LICENSED = [
    (100, "Copyright (c) 2019 Somebody\n\n" + license_texts.MIT),
    (101, "mit LICENCE\n© 2001 x\n" + license_texts.MIT.replace(",", " ,").replace("\n", "  \n").upper()),
    (102, license_texts.ISC.replace("AS IS", "AS-IS")),
    (103, "Some prose.\nReleased under the MIT Licence.\nLicensed under CC BY-NC 4.0\nMore."),
    (104, license_texts.MIT + "\nbut not for you"),
    (105, "(c) 1999 only a copyright line"),
]


def test_license_scan_finds_variants(frame):
    found = {r.doc_id: r for r in licenses.scan(frame(LICENSED)).collect()}
    assert [found[i].license for i in range(100, 106)] == ["MIT", "MIT", "ISC", None, None, None]
    assert found[103].line_licenses == "CC-BY-NC-4.0,MIT" and found[103].n_license_lines == 2
    assert found[105].digest is None


def _labelled(spark, frame):
    texts = made_texts(seed=9, n=200)
    draw = np.random.default_rng(1)
    rows, labels = [], []
    for i, t in enumerate(texts):
        bad = bool(draw.random() < 0.3)
        rows.append((i, " | ".join(t.split(" ")).upper() + "!!" if bad else t))
        labels.append((i, int(not bad), 0))
    return frame(rows, extra=True), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), labels


def test_classifier_learns_and_keeps_out_held_out_labels(spark, frame):
    docs, labels, known = _labelled(spark, frame)
    held = lambda i: fold("doc_id", 3) == 1
    found = quality_model.score_documents(docs, labels, ~held(0)).collect()
    score = {r.doc_id: r.score for r in found}
    assert len(found) == 200 and all(0 <= s <= 1 for s in score.values())
    out = {r.doc_id for r in docs.filter(held(0)).select("doc_id").collect()}
    right = [(score[i] >= 0.5) == bool(q) for i, q, _ in known if i in out]
    assert np.mean(right) > 0.9
    turned = labels.withColumn("quality", F.when(held(0), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_model.score_documents(docs, turned, ~held(0)).collect()}
    assert all(again[i] == pytest.approx(score[i], abs=1e-6) for i in score)
    kept = quality_model.keep_good(docs, labels, ~held(0))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in score.items() if s >= 0.5}


def test_classifier_without_labels_or_documents(spark, frame, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_model.score_documents(frame(odd), none, F.lit(True)).collect()} == {0.5}
    assert quality_model.score_documents(frame([]), none, F.lit(True)).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 1), (3, 1), (5, 0)], "doc_id bigint, quality int")
    found = quality_model.score_documents(frame(odd), nulls, F.lit(True)).collect()
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)


def test_pooling_ascends():
    draw = np.random.default_rng(2)
    _, values = quality_model.pooled(np.arange(50.0), draw.integers(1, 9, 50).astype(float), draw.random(50))
    assert (np.diff(values) >= 0).all()

"""Vector codes against the same rounds with every distance evaluated, in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_codes(rows, parts=16, most=64, rounds=2):
    """[(id, code, error, label_error, digest)] of [(id, vector, label)]."""
    usable = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)
    ]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    usable = [r for r in usable if len(r[1]) == len(usable[0][1])]
    size = len(usable[0][1]) // parts if usable else 0
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in usable]
    books = [[c[p] for c in cut[:most]] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(books[p])) for p, part in enumerate(c)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {}
    for (_, _, label), f in zip(usable, found):
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in f)
    return [
        (i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[label], digest)
        for (i, _, label), f in zip(usable, found)
    ]


def vectors(n, width=64, seed=1, spread=0.2):
    draw = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    return [(i * 3 - 5, [f32(draw.gauss(0, spread)) for _ in range(width)], draw.choice([0, 1, None])) for i in range(n)]


def odd_vectors():
    rows = vectors(90, 32, seed=2)
    inf, nan = float("inf"), float("nan")
    bad = [(1000, None, 1), (1001, [], 1), (-90, [nan] * 32, 1), (-91, [inf] + [0.0] * 31, 2), (-92, [None] + [0.0] * 31, 2), (-93, [0.0] * 7, 2)]
    repeats = [rows[4], rows[4], (rows[0][0], rows[8][1], 7), (None, rows[9][1], None), (None, rows[9][1], None)]
    ties = [(500 + k, [0.0, -0.0] * 16, 3) for k in range(20)]
    return rows + bad + repeats + ties + [(2000, [0.5] * 48, 1), (2001, [900.0, -900.0] * 16, 4)]


def bag(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


CASES = {
    "gauss": vectors(300),
    "odd": odd_vectors(),
    "few": vectors(5, 16),
    "same": [(i, [0.25] * 32, None) for i in range(80)],
    "hot": [(i, [0.1 * (i % 3 > 0) * k for k in range(16)], 1 if i % 3 else i) for i in range(150)],
    "none": [],
    "unusable": [(1, None, 1), (2, [float("nan")] * 16, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_codes(spark, case, tmp_path):
    df = spark.createDataFrame(CASES[case], SCHEMA)
    for name in ("vector", "components", "far", "code", "error", "own_label"):
        df = df.withColumn(name, F.lit("x"))
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_vector_codes(spark, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "string", "bigint", "bigint", "string"]
    assert bag(found.collect()) == bag(plain_codes(CASES[case]))


def test_bounds_prune_and_never_miss():
    draw = np.random.default_rng(3)
    for spread, width, share in ((3, 2, 0.5), (300, 4, 0.5), (40_000_000, 8, 0.7)):
        points, entries = (draw.integers(-spread, spread, (n, width)) for n in (500, 64))
        entries[5] = entries[3]
        pivots = vector_codes.choose_pivots(entries[None], vector_codes.PIVOTS)
        far, entry_far = (vector_codes.distances(x[None], pivots)[0] for x in (points, entries))
        index, best, evaluated = vector_codes.nearest(points, far, entries, entry_far)
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
        assert evaluated < share * every.size
    none = vector_codes.nearest(points[:0], far[:0], entries, entry_far)
    assert len(none[0]) == 0


def test_pivots_are_far_apart():
    entries = np.array([[[0, 0], [1, 0], [10, 0], [0, 9]]])
    assert vector_codes.choose_pivots(entries, 3).tolist() == [[[0, 0], [10, 0], [0, 9]]]


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rows = vectors(120, 32)
    df = spark.createDataFrame(rows, SCHEMA)
    coded, books = vector_codes.compress(df, parts=8, entries=16, rounds=1)
    back = {r.vec_id: r.vector for r in vector_codes.decode(coded, books).collect()}
    given = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    for r in coded.collect():
        assert sum((a - round(256 * b)) ** 2 for a, b in zip(given[r.vec_id], back[r.vec_id])) == r.error
    null = spark.createDataFrame([(1, None)], "vec_id bigint, code string")
    assert vector_codes.decode(null, books).collect()[0].vector is None


def test_numbers_beyond_exact_distances_are_refused():
    with pytest.raises(ValueError):
        vector_codes.integers(np.array([1e12]), 16)

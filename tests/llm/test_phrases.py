"""Phrase mining against counting every phrase in a dictionary, and the tries against sets."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import made_texts
from tidemark.llm import double_array, phrases, queries


def plain_phrases(rows, least=10, longest=3, top=2000, cover=50):
    """[(lang, rank, phrase, a, l, r, n, score)] of [(text, lang)]."""
    by_lang = collections.defaultdict(list)
    for text, lang in rows:
        by_lang["und" if lang is None else lang].append(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    made = []
    for lang, texts in by_lang.items():
        f = collections.Counter()
        for text in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", text):
                words = tuple(w for w in re.split("[\x20\x09]", piece) if w)
                for k in range(1, longest + 1):
                    f.update(words[i : i + k] for i in range(len(words) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = [p for p, c in f.items() if len(p) > 1 and c >= least]
        most = collections.Counter()
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], f[p])
        found = []
        for p in candidates:
            a = f[p]
            if p in most and 100 * most[p] >= cover * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((" ".join(p), a, f[p[:k]], f[p[k:]], score))
        found.sort(key=lambda r: (-r[4], -r[1], r[0].encode()))
        made += [(lang, rank, p, a, left, right, n, s) for rank, (p, a, left, right, s) in enumerate(found[:top], 1)]
    return made


def texts_by_lang():
    draw = random.Random(5)
    rows = [(t, draw.choice(["en", "fr", None, "und"])) for t in made_texts(seed=7, n=240)]
    hard = "New York. New\tYork, NEW YORK\nnew york;new york!new york?new york:new york \x0bnew york\x0cnew york\rnew york city"
    rows += [(hard, "x"), (None, "x"), ("", "x"), ("   ", "empty"), ("é\x00 ü  é\x00 ü " * 12, "x"), ("a a a a a a a a a a a a a", "rep")]
    return rows + rows[:9] + [(" ".join(t for t, _ in rows[:60]) * 3, "long")]


CASES = {
    "all": lambda: texts_by_lang(),
    "hot": lambda: [("the same old song and dance", "en")] * 400 + [("the other song", "en")] * 5,
    "rare": lambda: [("one two three", "en")] * 9,
    "none": lambda: [],
}


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("case", CASES)
def test_collocations(spark, case, small, monkeypatch, tmp_path):
    if small:  # many blocks, many shards, windows in parts
        monkeypatch.setattr(phrases, "BLOCK_WORDS", 300)
        monkeypatch.setattr(phrases, "SHARD", 40)
        monkeypatch.setattr(phrases, "WINDOWS", 500)
        monkeypatch.setattr(phrases, "ROWS", 7)
        monkeypatch.setattr(phrases, "SLICE", 16)
        monkeypatch.setattr(phrases, "HALF", 2)
    rows = CASES[case]()
    df = spark.createDataFrame(rows, "text string, lang string")
    for name in ("doc_id", "block", "words", "n", "w0", "rank", "id", "phrase"):
        df = df.withColumn(name, F.lit(1))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_phrase_mining(spark, str(tmp_path))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {f.dataType.simpleString() for f in found.schema} == {"string", "bigint"}
    assert sorted(map(tuple, found.collect())) == sorted(plain_phrases(rows))


@pytest.mark.parametrize("longest,least,top,cover", [(2, 3, 20, 50), (4, 3, 50, 80), (3, 2, 2000, 1)])
def test_other_parameters(spark, longest, least, top, cover):
    rows = texts_by_lang()[:120]
    df = spark.createDataFrame(rows, "text string, lang string")
    found = phrases.collocations(df, least=least, longest=longest, top=top, cover=cover)
    assert sorted(map(tuple, found.collect())) == sorted(plain_phrases(rows, least, longest, top, cover))


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([(10**12, 10**12 + 1, 10**12 + 7)], "a bigint, x bigint, y bigint")
    found = counts.select(phrases._score("a", "x", "y")).first()[0]
    assert found == 10**6 * 10**24 // ((10**12 + 1) * (10**12 + 7))


@pytest.mark.parametrize("highest,n,words", [(1, 1, 2), (3, 9, 2), (40, 300, 3), (5000, 4000, 2), (300_000, 2500, 3), (2**21, 900, 2)])
def test_tries(highest, n, words):
    draw = np.random.default_rng(highest)
    rows = np.unique(np.minimum(highest, draw.zipf(1.3, (n, words))).astype(np.int64), axis=0)
    trie = double_array.build(rows, highest)
    assert len(set(trie.states.tolist())) == len(rows)
    ids = np.concatenate([np.minimum(highest, draw.zipf(1.3, 3000)), rows.ravel(), [0], rows[::-1].ravel()]).astype(np.int32)
    ids[draw.integers(0, 3000, 200)] = 0
    at, state = trie.match(ids)
    known = {tuple(r): s for r, s in zip(rows.tolist(), trie.states.tolist())}
    expected = {i: known[p] for i in range(len(ids) - words + 1) if (p := tuple(ids[i : i + words].tolist())) in known}
    assert dict(zip(at.tolist(), state.tolist())) == expected and len(at) == len(expected)
    for short in (ids[:0], ids[: words - 1]):
        assert len(trie.match(short)[0]) == 0

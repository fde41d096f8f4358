"""Each stage of the pipeline against a plain version on the stage's own input."""

import collections

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_against_plain import bag
from tests.llm.test_quality_licenses_lines import _labelled
from tests.llm.test_similar_texts import _first_of_groups as first_of_groups
from tidemark.llm import bpe, line_dedup, quality_model
from tidemark.llm.common import fold


@pytest.fixture(scope="module")
def folder(spark, frame, plain, tmp_path_factory):
    """A folder of tables: ordinary documents, junk among them, labels and a benchmark."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs, labels, _ = _labelled(spark, frame)
    more = frame([(i + 1000, t) for i, t in plain])
    docs.select(*more.columns).unionByName(more).coalesce(2).write.parquet(f"{path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{path}/labels.parquet")
    items = spark.createDataFrame([(1, plain[0][1]), (2, plain[12][1])], "item_id bigint, text string")
    items.coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append((rows(docs), rows(spark.read.parquet(f"{tmp_path}/{name}"))))
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    (given, good), (before, lines), (within, single), (open_, clean) = kept

    scores = quality_model.score_documents(
        spark.read.parquet(f"{folder}/documents.parquet"), labels, fold("doc_id", 3) != 1
    )
    accepted = {r.doc_id for r in scores.collect() if r.score >= 0.5}
    assert bag(good) == bag((i, t) for i, t in given if i in accepted) and len(good) < len(given)

    # Against every pair of lines by edit similarity (`similar` is tested against plain distances):
    # only what is similar goes, and of that nine tenths or more, since lines are nominated by chance.
    left = dict(brute.kept_lines(before, bits=64, alike=lambda x, y: line_dedup.similar(x, y, 0.8)))
    after, gone, wanted = dict(lines), 0, 0
    for i, t in before:
        own, rest = t.split("\n"), after.get(i, "").split("\n") if i in after else []
        worded = [k for k, x in enumerate(own) if brute.words(x)]
        stay = [x for k, x in enumerate(own) if k not in worded or k in left[i]]
        places = iter(own)
        assert all(x in places for x in rest), "lines stay in order"
        if i not in after:
            assert worded and not left[i]
        else:
            assert not collections.Counter(stay) - collections.Counter(rest), "only similar lines go"
        wanted += len(worded) - len(left[i])
        gone += len(worded) - sum(bool(brute.words(x)) for x in rest)
    assert wanted >= gone >= 0.9 * wanted > 40

    first = set(first_of_groups(within))  # every pair by its Jaccard similarity
    assert bag(single) == bag((i, t) for i, t in within if i in first)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {i for i, _, hit, _ in brute.contamination(open_, items) if hit}
    assert bag(clean) == bag((i, t) for i, t in open_ if i not in dirty) and dirty

    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    made = corpus_pipeline.run(spark, folder).collect()
    assert bag((r.doc_id, tuple(r.ids), r.n_tokens, r.exact) for r in made) == bag(
        (i, tuple(own.encode_ordinary(t)), len(own.encode_ordinary(t)), True) for i, t in clean
    )
    assert np.all([r.exact for r in made])

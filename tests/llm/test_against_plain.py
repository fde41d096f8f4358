"""Operators without a SQL form against plain versions, on ordinary and on odd inputs, and on none."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import anchors, bpe, byte_dedup, fm_index, katz, line_dedup, simhash, suffix_groups
from tidemark.llm.common import fold

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def bag(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.fixture(params=["plain", "odd", "none"])
def rows(request):
    return [] if request.param == "none" else request.getfixturevalue(request.param)


def test_byte_strings(frame, rows):
    found = byte_dedup.drop_repeats(frame(rows, extra=True), length=50)
    found = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert bag(found.collect()) == bag(brute.byte_dedup(rows))


def test_byte_strings_of_common_anchors_and_many_contexts(frame, plain, monkeypatch):
    monkeypatch.setattr(byte_dedup, "MOST_CONTEXTS", 2)
    by_string = byte_dedup.earliest_by_suffixes([[b"a" * 60 + b"b", b"c" + b"a" * 60]], [[7, 5]], 50)[0]
    assert [x.tolist() for x in by_string] == [x.tolist() for x in byte_dedup._by_string([b"a" * 60 + b"b", b"c" + b"a" * 60], [7, 5], 50)]
    texts = byte_dedup.Texts(np.array([1, 2]), np.array([True, True]), [b"ab" * 40, b"x" + b"ab" * 40], 50)
    answers = {b: [byte_dedup.pack(np.full(n, 2))] for b, n in enumerate(np.diff(byte_dedup.edges_by_range(texts.asked()[0], 48, 4)))}
    pieces = byte_dedup.Pieces(texts, answers, 4)
    assert {len(b) for b in pieces.bodies} == {50}


def test_anchors_are_dealt_evenly_over_buckets_and_rounds():
    rnd = np.random.default_rng(3)
    text = bytes(rnd.integers(97, 123, 60_000, dtype=np.uint8))
    texts = byte_dedup.Texts(np.array([1, 2]), np.array([True, True]), [text, text], 50)
    edges = byte_dedup.edges_by_range(texts.distinct, 48, 12)
    assert np.diff(edges).max() < 1.5 * len(texts.distinct) / 12
    answers = {b: [byte_dedup.pack(np.ones(n, np.int64))] for b, n in enumerate(np.diff(edges))}
    turns = [byte_dedup.Pieces(texts, answers, 12, turn) for turn in range(byte_dedup.ROUNDS)]
    whole = byte_dedup.Pieces(texts, answers, 12)
    assert sorted(b for p in turns for b in p.bodies) == sorted(whole.bodies)
    assert max(len(p.bodies) for p in turns) < 1.5 * len(whole.bodies) / byte_dedup.ROUNDS


def test_contexts_do_not_depend_on_the_slices_they_are_found_in(monkeypatch):
    rnd = np.random.default_rng(4)
    text = np.concatenate([rnd.integers(97, 100, 4000, dtype=np.uint8), np.full(300, 97, np.uint8)])
    ends = np.repeat([1500, 1510, len(text)], [1500, 10, len(text) - 1510])
    whole = byte_dedup.contexts(text, ends, 50)
    monkeypatch.setattr(byte_dedup, "_SLICE", 256)
    assert [x.tolist() for x in byte_dedup.contexts(text, ends, 50)] == [x.tolist() for x in whole]


def test_suffix_orders():
    draw = np.random.default_rng(1)
    strings = [draw.integers(1, 2 + k % 4, size=k % 37) for k in range(150)] + [np.tile([1, 2], 40), np.full(50, 3)]
    text = np.concatenate([np.append(s, 0) for s in strings])
    base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    order = suffix_groups.suffix_orders(text, base)
    for a, b in zip(base[:-1], base[1:]):
        assert order[a:b].tolist() == sorted(range(a, b), key=lambda i: text[i:b].tolist())


def test_word_windows(frame, rows):
    found = anchors.drop_repeats(frame(rows, extra=True), window=13)
    found = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert bag(found.collect()) == bag(brute.word_dedup(rows))


def test_near_duplicates(frame, rows):
    found = simhash.near_duplicates(frame(rows, extra=True), width=4, bits=4)
    found = found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert bag(found.collect()) == bag(brute.near_duplicates(rows))


def test_hot_block_keys_are_dealt_in_chunks(spark):
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 1 << 62, 3)
    values = sorted({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in draw.integers(0, 62, (60, 2))})
    expected = brute.groups(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4])
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    edges = simhash.linked_values(df, bits=4, blocks=7, chunk=8).collect()
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    at = {v: i for i, v in enumerate(values)}
    assert brute.groups(len(values), [(at[a], at[b]) for a, b in edges]) == expected


def test_keep_one_of_each_component(frame, plain, odd):
    found = simhash.keep_one(frame(plain, extra=True), width=4, bits=4, blocks=7)
    assert sorted(r.doc_id for r in found.collect()) == sorted({c for _, _, c in brute.near_duplicates(plain)})
    assert found.columns == frame(plain, extra=True).columns
    left = simhash.keep_one(frame(odd), width=4, bits=4, blocks=7).collect()
    assert {r.doc_id for r in left} == {c for _, _, c in brute.near_duplicates(odd)}


def test_lines(frame, plain):
    found = line_dedup.kept_lines(frame(plain, extra=True)).select("doc_id", "kept")
    assert bag(found.collect()) == bag(brute.kept_lines(plain))
    kept = dict(brute.kept_lines(plain))
    expected = []
    for i, t in plain:
        lines = t.split("\n")
        blank = {k for k, x in enumerate(lines) if not brute.words(x)}
        if kept[i] or len(blank) == len(lines):
            expected.append((i, "\n".join(x for k, x in enumerate(lines) if k in blank or k in kept[i])))
    out = line_dedup.drop_repeated_lines(frame(plain, extra=True))
    assert bag(out.select("doc_id", "text").collect()) == bag(expected)
    assert out.columns == frame(plain, extra=True).columns


def test_lines_of_odd_rows(frame, odd):
    out = line_dedup.drop_repeated_lines(frame(odd)).collect()
    assert {(None, None), (50, None), (51, "")} <= {(r.doc_id, r.text) for r in out}
    assert sum(r.doc_id == 3 for r in out) in (0, 2)  # repeated rows are one document
    assert line_dedup.drop_repeated_lines(frame([])).count() == 0


def test_edit_distance():
    draw = np.random.default_rng(4)
    for _ in range(300):
        a, b = ("".join("abé"[i] for i in draw.integers(0, 3, n)) for n in draw.integers(0, 70, 2))
        d = brute.distance(a, b)
        assert line_dedup.edit_distance(a, b) == d
        if a or b:
            assert line_dedup.similar(a, b, 0.8) == (1 - d / max(len(a), len(b)) >= 0.8 - 1e-12)


def test_katz_scores(frame, rows, monkeypatch):
    monkeypatch.setattr(katz, "BATCH_TOKENS", 700)
    found = katz.score_documents(frame(rows, extra=True), fold("doc_id", 7) == 2).collect()
    expected, _ = brute.katz(rows)
    assert bag(r[:5] for r in found) == bag(r[:5] for r in expected)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_katz_distributions_sum_to_one(plain):
    _, (p, known, histories) = brute.katz(plain)
    for h in [*histories[:5], "^", "never seen"]:
        assert sum(p(w, h) for w in known) + p("never seen either", h) == pytest.approx(1)


ITEMS = [(1, "short one"), (2, None), (None, "the of and to stone river"), (3, "ONE"), (3, "ONE"), (4, " ... "), (11, "na " * 14)]


def test_contamination(spark, frame, rows, plain):
    items = [*ITEMS, (5, plain[6][1]), (6, plain[8][1] + plain[9][1])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = fm_index.contamination(frame(rows, extra=True), table).collect()
    made = [(r.doc_id, r.n_words, [k for s in r.spans for k in range(s.first, s.past)], r["items"]) for r in found]
    expected = brute.contamination(rows, items)
    assert bag(made) == bag(expected)
    clean = fm_index.drop_contaminated(frame(rows, extra=True), table)
    assert bag((r.doc_id,) for r in clean.collect()) == bag((i,) for i, _, hit, _ in expected if not hit)


def test_contamination_in_blocks_and_without_items(spark, frame, plain, monkeypatch):
    items = [*ITEMS, (5, plain[6][1]), (6, plain[8][1])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 400)
    monkeypatch.setattr(fm_index.item_blocks, "__defaults__", (400,))
    found = fm_index.contamination(frame(plain), table).collect()
    made = [(r.doc_id, r.n_words, [k for s in r.spans for k in range(s.first, s.past)], r["items"]) for r in found]
    assert bag(made) == bag(brute.contamination(plain, items))
    none = fm_index.contamination(frame(plain), table.limit(0)).collect()
    assert len(none) == len(plain) and not any(r.spans for r in none)


def test_bpe_is_that_of_the_library(frame, rows):
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        expected.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode()), True))
    found = bpe.round_trip(frame(rows, extra=True), RANKS, public_tokenizers.PATTERN)
    assert bag(found.collect()) == bag(expected)


def test_bpe_of_hard_pieces():
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(ranks)
    draw = np.random.default_rng(6)
    for k in range(400):
        piece = "".join("abcdeéà语 "[i] for i in draw.integers(0, 2 + k % 7, k % 50 + 1))
        assert encoder.encode(piece.encode()) == own._core_bpe.encode_single_piece(piece.encode())


def test_decoding_gives_the_text_back(frame, odd):
    encoded = bpe.encode_documents(frame(odd), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_documents(encoded, RANKS).collect()
    assert bag((r.doc_id, hashlib.sha256(r.decoded).hexdigest()) for r in back) == bag((i, brute.sha((t or "").encode())) for i, t in odd)

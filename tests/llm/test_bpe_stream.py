"""The streaming transducer against the tokenizers library and against merging everything at once."""

import itertools
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tidemark.llm import bpe_stream, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
#: Blanks, marks and classes at which splitters differ, and cut-off added tokens.
BITS = [
    "a", "b", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'", "1", "²", "é", "ß", "中", "😀", "!", "?!",
    "<|endoftext|>", "<|endo", "Ã", "=", "-", "\u0085", " ", "　", "\x1c", "\x1f", "՘", "₏", "\U0003d000",
    "\U00011de0", "Ᲊ", "​", "\x00", "�",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe_stream.Vocabulary(FILE)


def encode(vocabulary, text, sizes=None):
    """Ids of a text that is handed over in parts."""
    encoder, place, found = bpe_stream.Encoder(bpe_stream.Pieces(vocabulary)), 0, []
    while place < len(text):
        size = next(sizes) if sizes else len(text)
        found += itertools.chain.from_iterable(encoder.feed(text[place : place + size]))
        place += size
    return found + list(itertools.chain.from_iterable(encoder.finish()))


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library(vocabulary):
    draw = random.Random(1)
    for _ in range(700):
        text = "".join(draw.choice(BITS) * draw.choice([1, 1, 1, 2, 5]) for _ in range(draw.randint(0, 30)))
        assert encode(vocabulary, text) == expected(text)


def test_parts_make_no_difference(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe_stream, "CHUNK", 64)
    monkeypatch.setattr(bpe_stream, "BLOCK", 256)
    monkeypatch.setattr(bpe_stream, "LONG_PIECE", 10)
    draw = random.Random(2)
    for _ in range(400):
        text = "".join(draw.choice(BITS) * draw.choice([1, 2, 5, 40, 300]) for _ in range(draw.randint(0, 12)))
        for most in (1, 50, 500):
            assert encode(vocabulary, text, (draw.randint(1, most) for _ in itertools.count())) == expected(text)


def test_long_pieces(vocabulary):
    draw = random.Random(3)
    letters = [t.decode() for t in vocabulary.bytes_of.values() if t.isalpha()]
    texts = ["".join(draw.choice(letters) for _ in range(900)) for _ in range(30)]
    texts += [draw.choice(["ÃÂ", "=-", "aA", " \n", "ab", "é"]) * draw.randint(1, 4000) + " x" for _ in range(30)]
    for text in [*texts, "a" * 300_000 + " " * 200_000 + "z" + "!?" * 100_000]:
        assert encode(vocabulary, text) == expected(text)


def test_lookahead_suffices(vocabulary):
    """Whatever follows, a token with that many bytes behind it stays; checked on the chains that the bound is about."""
    draw = random.Random(4)
    letters = [t for t in vocabulary.bytes_of.values() if t.isalpha()]
    for _ in range(150):
        data = b"".join(draw.choice(letters) for _ in range(300))
        cut = draw.randint(vocabulary.lookahead, len(data))
        short, whole = vocabulary.merge(data[:cut]), vocabulary.merge(data)
        ends = list(itertools.accumulate(len(vocabulary.bytes_of[i]) for i in short))
        settled = sum(e <= cut - vocabulary.lookahead for e in ends)
        assert short[:settled] == whole[:settled]
        assert vocabulary._by_scan(data) == vocabulary._by_heap(data) == whole


def test_lookahead_of_small_lists():
    assert bpe_stream.sufficient_lookahead([]) == 0
    assert bpe_stream.sufficient_lookahead([("a", "b")]) == 1
    # "b" before "c" decides about (b, c), and that about (a, b): two steps back.
    assert bpe_stream.sufficient_lookahead([("b", "c"), ("a", "b")]) == 2
    assert bpe_stream.sufficient_lookahead([("a", "b"), ("b", "c")]) == 1
    with pytest.raises(ValueError):
        bpe_stream.sufficient_lookahead([("ab", "c")])
    with pytest.raises(ValueError):
        bpe_stream.sufficient_lookahead([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")])


def test_window_stays_bounded(vocabulary):
    encoder = bpe_stream.Encoder(bpe_stream.Pieces(vocabulary))
    for _ in range(40):
        for ids in encoder.feed("ab" * 50_000):
            assert len(ids) <= 2 * bpe_stream.CHUNK
        assert len(encoder.rest) <= 2 * bpe_stream.CHUNK
        assert encoder.open is None or len(encoder.open[1].window) <= vocabulary.lookahead + 2 * bpe_stream.BLOCK


def test_decoding_in_parts(vocabulary):
    draw = random.Random(5)
    for _ in range(200):
        ids = [draw.choice(list(vocabulary.bytes_of)) for _ in range(draw.randint(0, 30))] + [99_999]
        decoder = bpe_stream.Decoder(vocabulary)
        text = "".join(decoder.feed([i]) for i in ids) + decoder.finish()
        assert text == LIBRARY.decode(ids, skip_special_tokens=False)


def test_other_forms_are_refused(tmp_path):
    with open(FILE, encoding="utf-8") as file:
        given = json.load(file)
    given["model"]["byte_fallback"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(given))
    with pytest.raises(ValueError):
        bpe_stream.Vocabulary(str(path))


def digests(rows):
    for i, t in rows:
        ids = expected(t or "")
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        yield i, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(back.encode())


def bag(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.mark.parametrize("which", ["plain", "odd", "none"])
def test_documents(frame, request, which):
    rows = [] if which == "none" else request.getfixturevalue(which) + [(900, "a<|endoftext|> b"), (901, "x" * 70_000)]
    found = bpe_stream.round_trip(frame(rows, extra=True), FILE)
    assert bag(r[:4] for r in found.collect()) == bag(digests(rows))
    assert found.filter("not exact").count() == 0
    encoded = bpe_stream.encode_documents(frame(rows, extra=True), FILE)
    assert bag((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == bag((i, tuple(expected(t or ""))) for i, t in rows)
    back = bpe_stream.decode_documents(encoded, FILE)
    assert bag(back.collect()) == bag((i, t or "") for i, t in rows)


def test_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (None, []), (2, [64, None, 10**6])], "doc_id bigint, ids array<int>")
    assert bag(bpe_stream.decode_documents(df, FILE).collect()) == bag([(1, ""), (None, ""), (2, "a")])


def test_query(spark, frame, plain, odd, tmp_path):
    rows = plain + odd
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_bpe_stream(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bag(found.collect()) == bag(digests(rows))

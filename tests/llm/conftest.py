import random

import pytest
from pyspark.sql import types as T

LETTERS = ["the", "of", "and", "to", "stone", "river", "élan", "Über", "çava", "x9", "blue", "green", "long", "Short"]

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def sentence(rnd, n):
    return " ".join(rnd.choice(LETTERS) + rnd.choice(["", "", "a", "is", "ment", "er,", "."]) * rnd.randint(0, 2) for _ in range(n))


def made_texts(seed=1, n=60):
    """Prose with exact copies, near copies, shared passages, repeated words, short and blank texts."""
    rnd = random.Random(seed)
    passage, header = sentence(rnd, 45), sentence(rnd, 11)
    texts = []
    for k in range(n):
        kind = k % 10
        if kind == 3:
            texts.append(texts[rnd.randrange(k)])
        elif kind in (4, 5):
            words = texts[rnd.randrange(k)].split(" ")
            words[rnd.randrange(len(words))] = "swapped"
            texts.append(" ".join(words))
        elif kind == 6:
            texts.append(sentence(rnd, 20) + "\n" + passage + "\n" + sentence(rnd, 5))
        elif kind == 7:
            texts.append("na " * rnd.randint(1, 90) + "aaaa" * rnd.randint(0, 40))
        elif kind == 8:
            texts.append(header + "\n" + sentence(rnd, rnd.randint(1, 60)) + "\n\n \t\r\n" + sentence(rnd, 3))
        else:
            texts.append("\n".join(sentence(rnd, rnd.randint(1, 40)) for _ in range(rnd.randint(1, 5))))
    return texts


@pytest.fixture(scope="session")
def plain():
    """[(id, text)] with ids from -3 on, empty texts included."""
    texts = made_texts()
    return [(i - 3, t) for i, t in enumerate([*texts, "", "   ", "one", "ONE"])]


@pytest.fixture(scope="session")
def odd():
    """[(id, text)] with null ids and texts, repeated rows and ids, and one very long text."""
    texts = made_texts(seed=2, n=20)
    long = " ".join(made_texts(seed=3, n=40)) * 12
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, texts[0]), (None, None), (50, None), (51, ""), (3, texts[3]), (4, texts[9]), (52, long), (53, long)]


@pytest.fixture(scope="session")
def frame(spark):
    """A function from [(id, text)] to a table of documents; ``extra`` adds columns whose names operators use inside."""

    def make(rows, extra=False):
        df = spark.createDataFrame(
            [(i, t, "en", None if k % 5 == 4 else f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)], DOCUMENTS
        )
        if extra:
            for name in ("row", "fp", "body", "key", "host", "h", "own_body", "kept_lines", "batch", "bucket", "Words"):
                df = df.withColumn(name, df["doc_id"])
        return df

    return make

"""Document quality: random Fourier features, ridge scores, isotonic calibration.

A document is described by statistics of its whole text. Random cosines of the
standardised statistics approximate a Gaussian kernel; a ridge fit on them needs
only the sums of their products, which every partition adds up for itself. The
raw score is turned into a probability by a monotone step fit over score bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text
from tidemark.session import cut_lineage

STATISTICS = (
    "log_words",
    "log_bytes",
    "word_length",
    "distinct_words",
    "repeated_neighbours",
    "commonest_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "bang_share",
    "stop_share",
    "newline_share",
    "high_byte_share",
    "repeated_lines",
    "longest_line",
    "byte_entropy",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def statistics(text: bytes) -> list[float]:
    """The values named in ``STATISTICS``; all zero for a text without bytes."""
    if not text:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, words = len(text), text.split()
    n = max(1, len(words))
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = histogram[histogram > 0] / size
    of = lambda characters: float(histogram[list(characters)].sum())
    return [
        float(np.log1p(len(words))),
        float(np.log1p(size)),
        min(40.0, (size - of(b" \t\n\r\x0b\x0c")) / n),
        len(counts) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        max(counts.values(), default=0) / n,
        float(histogram[_UPPER].sum()) / max(1.0, float(histogram[_LETTER].sum())),
        of(b"0123456789") / size,
        of(b"#*$%&|<>") / size,
        of(b"!?") / size,
        of(b".,;:") / size,
        of(b"\n") / size,
        float(histogram[128:].sum()) / size,
        1.0 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(max(map(len, lines), default=0))),
        float(-(share * np.log2(share)).sum()),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one double per statistic) for every row; a null text counts as empty."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics((t.as_py() or "").encode()) for t in batch.column(1)]
            made = np.array(rows, np.float64).reshape(-1, len(STATISTICS))
            yield pa.record_batch(
                [batch.column(0), *[pa.array(made[:, i]) for i in range(len(STATISTICS))]], ["doc_id", *STATISTICS]
            )

    schema = "doc_id bigint, " + ", ".join(f"{name} double" for name in STATISTICS)
    return id_and_text(docs, id_col, text_col).mapInArrow(over, schema)


@dataclass(frozen=True)
class Model:
    """All that is needed to score a row of statistics; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        standard = np.clip((rows - self.mean) / self.scale, -6.0, 6.0)
        waves = np.cos(standard @ self.frequencies + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.hstack([waves, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), self.knots, self.values), 0.0, 1.0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for name in STATISTICS]
    return np.column_stack(columns).astype(np.float64)


def pooled(scores: np.ndarray, weights: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic fit: block centres and block means, neighbours pooled until the means ascend."""
    blocks: list[list[float]] = []
    for score, weight, target in zip(scores, weights, targets):
        blocks.append([score * weight, weight, target * weight])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    made = np.array(blocks).reshape(-1, 3)
    return made[:, 0] / made[:, 1], made[:, 2] / made[:, 1]


def fit(
    stats: DataFrame,
    labels: DataFrame,
    wanted: Column,
    label_col: str = "quality",
    label_id: str = "doc_id",
    waves: int = 128,
    width: float = 4.0,
    ridge: float = 1e-3,
    bins: int = 2000,
    seed: int = 7,
) -> Model:
    """Fit on the rows of ``stats`` that have a label 0 or 1 in ``labels`` and for which ``wanted`` holds.

    ``wanted`` is over the column ``doc_id``. Means and spreads are taken over all
    of ``stats``. What reaches the driver is one row of moments, ``waves + 1`` rows
    of sums and at most ``bins + 1`` score bins. Null labels and ids are left out;
    a document labelled twice counts twice. Without any label every score is 0.5.
    """
    moments = stats.agg(
        *[F.avg(c).alias(f"m_{c}") for c in STATISTICS], *[F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS]
    ).first()
    mean = np.array([moments[f"m_{c}"] or 0.0 for c in STATISTICS])
    scale = np.array([moments[f"s_{c}"] or 1.0 for c in STATISTICS])
    draw = np.random.default_rng(seed)
    frequencies = draw.normal(0.0, 1.0 / width, (len(STATISTICS), waves))
    phases = draw.uniform(0.0, 2 * np.pi, waves)
    blank = Model(mean, scale, frequencies, phases, np.zeros(waves + 1), np.array([0.0]), np.array([0.5]))

    marked = labels.select(
        F.col(label_id).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("_label")
    ).filter(F.col("_label").isin(0.0, 1.0) & wanted)
    known = cut_lineage(stats.join(marked, "doc_id").select(*STATISTICS, "_label"))
    size = waves + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 2))
        for batch in batches:
            z = blank.features(_matrix(batch))
            y = batch.column(len(STATISTICS)).to_numpy(zero_copy_only=False)
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ y
            total[0, size + 1] += len(y)
        if total[0, size + 1]:
            columns = [pa.array(np.arange(size, dtype=np.int32)), *[pa.array(total[:, i].copy()) for i in range(size + 2)]]
            yield pa.record_batch(columns, ["i", *[f"c{i}" for i in range(size + 2)]])

    names = [f"c{i}" for i in range(size + 2)]
    added = known.mapInArrow(sums, "i int, " + ", ".join(f"{c} double" for c in names))
    rows = added.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).orderBy("i").collect()
    if not rows:
        return blank
    table = np.array([[r[c] for c in names] for r in rows])
    n = table[0, size + 1]
    weights = np.linalg.solve(table[:, :size] / n + ridge * np.eye(size) / size, table[:, size] / n)
    fitted = Model(mean, scale, frequencies, phases, weights, np.array([0.0]), np.array([0.5]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = fitted.raw(_matrix(batch))
            at = np.rint((np.clip(raw, -0.5, 1.5) + 0.5) / 2 * bins).astype(np.int32)
            yield pa.record_batch([pa.array(at), pa.array(raw), batch.column(len(STATISTICS))], ["at", "raw", "label"])

    steps = (
        known.mapInArrow(binned, "at int, raw double, label double")
        .groupBy("at")
        .agg(F.avg("raw").alias("raw"), F.count(F.lit(1)).alias("n"), F.avg("label").alias("label"))
        .orderBy("at")
        .collect()
    )
    knots, values = pooled(*(np.array([float(r[c]) for r in steps]) for c in ("raw", "n", "label")))
    return Model(mean, scale, frequencies, phases, weights, knots, values)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of rows of statistics."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(model.score(_matrix(batch)))], ["doc_id", "score"])

    return stats.select("doc_id", *STATISTICS).mapInArrow(over, "doc_id bigint, score double")


def score_documents(
    docs: DataFrame, labels: DataFrame, wanted: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, score) of every row, from a model fitted on the wanted labels. Texts are read once."""
    stats = cut_lineage(document_statistics(docs, id_col, text_col))
    return score(stats, fit(stats, labels, wanted))


def keep_good(
    docs: DataFrame, labels: DataFrame, wanted: Column, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``.

    Scores are computed again next to the text, so rows with null or repeated ids
    are judged one by one and no text is shuffled.
    """
    model = fit(cut_lineage(document_statistics(docs, id_col, text_col)), labels, wanted)
    at = docs.columns.index(text_col)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics((t.as_py() or "").encode()) for t in batch.column(at)]
            good = model.score(np.array(rows, np.float64).reshape(-1, len(STATISTICS))) >= least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(over, docs.schema)

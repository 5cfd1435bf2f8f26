"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

The features approximate a Gaussian kernel. Tasks sum the normal equations of their labelled rows; Spark adds these
sums, and the driver solves one system whose size is the number of features. Features are rounded to whole multiples of
1 / ``GRAIN``, so all sums are exact and do not depend on the order of rows. The calibration is fitted on counts of
labels per score bin. All labelled rows take part; nothing is sampled.

Null and empty texts have the statistics 0 of an empty text and get a score like any other. Labels, lang, source and doc_id
are no inputs of a score. Several labels of one document count each; labels other than 0 and 1 and rows without doc_id do not.
Without any label all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.rules import measure
from mapstrata.llm.words import as_bytes, map_rows, split_words
from mapstrata.session import cut_lineage

STATISTICS = [
    "log_words", "distinct_share", "word_chars", "word_chars_spread", "symbols", "exclamations", "repeat_lines", "repeat_words", "upper",
    "digits", "sentence_ends", "commas", "words_per_line", "long_words", "short_words", "non_ascii", "top_word", "letters", "bars",
]
FEATURES, RIDGE, SEED, GRAIN, BINS = 384, 1.0, 7, 4096, 1000
CLASSES = np.zeros(256, dtype=np.int8)
for _kind, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".?!", b",;:", b"abcdefghijklmnopqrstuvwxyz"], 1):
    CLASSES[list(_chars)] = _kind
CLASSES[128:] = 6


def statistics(text: bytes | None) -> list[float]:
    """Numbers of about 0 to 3 that describe a text."""
    words = split_words(text)
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars, symbols, dup_lines, repeats, lines, exclaims = measure(text)
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    kinds = np.bincount(CLASSES[joined], minlength=7) / len(joined)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    share = lambda x: float(np.sqrt(min(x / n, 9.0)))
    return [
        np.log1p(n) / 3,
        len(counts) / n,
        min(chars / n, 20) / 5,
        min(float(sizes.std()), 20.0) / 5,
        share(symbols),
        share(exclaims),
        dup_lines / max(1, lines),
        repeats / n,
        float(np.sqrt(kinds[1])),
        float(np.sqrt(kinds[2])),
        share(float(kinds[3] * len(joined))),
        share(float(kinds[4] * len(joined))),
        np.log1p(n / max(1, lines)) / 3,
        float((sizes > 12).mean()),
        float((sizes <= 3).mean()),
        float(np.sqrt(kinds[6])),
        max(counts.values()) / n,
        float(kinds[1] + kinds[5] + kinds[6]),
        share(text.count(b"|")),
    ]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row, written once."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        stats = [statistics(x) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return cut_lineage(map_rows(docs.select(as_bytes("text"), "doc_id"), rows, "doc_id long, stats array<double>"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        # a kernel as wide as the mean distance of two points of as many standardized numbers
        self.w = draw.normal(size=(len(mean), FEATURES)) / np.sqrt(len(mean))
        self.phase = draw.uniform(0, 2 * np.pi, FEATURES)
        self.weights, self.edges, self.levels = np.zeros(FEATURES + 1), np.zeros(1), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Whole numbers: cosines times ``GRAIN``, and a constant."""
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        cosines = np.rint(np.cos(z @ self.w + self.phase) * GRAIN)
        return np.concatenate([cosines, np.full((len(stats), 1), float(GRAIN))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights / GRAIN

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.edges, self.levels)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    size = FEATURES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, moment = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                x = model.features(_matrix(part.column("stats")))
                gram += x.T @ x  # whole numbers below 2 ** 53
                moment += x.T @ part.column("quality").to_numpy().astype(np.float64)
        at = np.arange(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, size + 1)), pa.array(np.tile(np.arange(size + 1), size)), pa.array(np.column_stack([gram, moment]).ravel().astype(np.int64))],
            ["i", "j", "x"],
        )

    summed = rows.mapInArrow(sums, "i long, j long, x long").groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    table = np.zeros((size, size + 1))
    table[summed["i"], summed["j"]] = summed["x"]
    return table[:, :size] / GRAIN**2, table[:, size] / GRAIN


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Rising values closest to ``means``, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for w, m in zip(weights, means):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks]) if blocks else np.zeros(0)


def fit(described_docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Model from all rows of ``labels`` that are not held out."""
    wanted = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    wanted = wanted.select("doc_id", F.col(label).cast("long").alias("quality"))
    rows = cut_lineage(described_docs.join(wanted, "doc_id").select("stats", "quality"))
    n = len(STATISTICS)
    scaled = [F.rint(F.col("stats")[i] * GRAIN).cast("long") for i in range(n)]
    moments = rows.agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"a{i}") for i, x in enumerate(scaled)), *(F.sum(x * x).alias(f"b{i}") for i, x in enumerate(scaled))
    ).first()
    total = moments["n"]
    if not total:
        return Model(np.zeros(n), np.ones(n))
    mean = np.array([moments[f"a{i}"] for i in range(n)]) / total / GRAIN
    square = np.array([moments[f"b{i}"] for i in range(n)]) / total / GRAIN**2
    model = Model(mean, np.sqrt(np.maximum(square - mean**2, 1e-4)))
    gram, moment = _normal_equations(rows, model)
    penalty = RIDGE * np.eye(len(gram))
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, moment)

    def binned(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = model.raw(_matrix(batch.column("stats")))
        at = np.clip(np.floor((raw + 1) / 3 * BINS), 0, BINS - 1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("quality")], ["bin", "quality"])

    counts = map_rows(rows, binned, "bin long, quality long").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("k"))
    counts = counts.orderBy("bin").toPandas()
    weights = counts["n"].to_numpy(np.float64)
    model.edges = (counts["bin"].to_numpy() + 0.5) / BINS * 3 - 1
    model.levels = isotonic(weights, counts["k"].to_numpy() / weights)
    return model


def scored(described_docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of every row; held_out is false without a doc_id."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], ["doc_id", "score"])

    out = map_rows(described_docs.select("doc_id", "stats"), rows, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score")

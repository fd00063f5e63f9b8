"""Quality scores: ridge on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ID, map_arrow, stored

HELD_OUT, CALIBRATION, FOLDS = 0, 4, 5


@dataclass(frozen=True)
class Settings:
    """``features`` random cosines of a Gaussian kernel whose width is ``width`` times the root of the number of
    statistics.  ``most_labels`` bounds the labelled rows used, drawn by hash; ``tasks`` sum the normal equations;
    ``bins`` is the resolution of the calibration; from ``threshold`` on a document is predicted good."""

    features: int = 256
    width: float = 1.0
    ridge: float = 1e-3
    most_labels: int = 200_000
    tasks: int = 16
    bins: int = 2_000
    threshold: float = 0.3
    seed: int = 11


STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "upper", "digit", "high", "full_stop", "comma",
    "exclaim", "pipe", "symbol", "other_punctuation", "space", "distinct_words", "repeated_lines", "capital_words",
)


def _of(text: str) -> list[float]:
    """The statistics of a whole text."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line]
    size, n_words = max(len(data), 1), max(len(words), 1)

    def share(characters: bytes) -> float:
        return float(counts[list(characters)].sum()) / size

    others = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,!|#*$%&<>")
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        min(len(data) / n_words, 50.0),
        float(counts[65:91].sum()) / size,
        float(counts[48:58].sum()) / size,
        float(counts[128:].sum()) / size,
        share(b"."),
        share(b","),
        share(b"!"),
        share(b"|"),
        share(b"#*$%&<>"),
        share(others),
        share(b" "),
        len(set(words)) / n_words,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(map(bytes.isupper, words)) / n_words,
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [_of(text.as_py() or "") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.list_(pa.float64()))], [ID, "x"]
        )


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


class Features:
    """Standardised statistics to cosines and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, settings: Settings):
        drawn = np.random.default_rng(settings.seed)
        self.mean, self.spread = mean, spread
        self.weights = drawn.normal(0, 1 / (settings.width * len(mean) ** 0.5), (len(mean), settings.features))
        self.phases = drawn.uniform(0, 2 * np.pi, settings.features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.spread, -8, 8)
        cosines = np.cos(standard @ self.weights + self.phases) * (2 / len(self.phases)) ** 0.5
        return np.hstack([cosines, np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), len(STATISTICS))


def _summed(features: Features):
    """Each partition's part of the normal equations, as one row of bytes."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(features.phases) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = features(_matrix(batch.column(0)))
            y = np.array(batch.column(1).to_pylist(), float)
            total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return of_batches


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to ``means`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for weight, mean in zip(weights, means):
        blocks.append([mean, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean2, weight2, n2 = blocks.pop()
            mean1, weight1, n1 = blocks[-1]
            blocks[-1] = [(mean1 * weight1 + mean2 * weight2) / (weight1 + weight2), weight1 + weight2, n1 + n2]
    return np.concatenate([np.full(int(n), mean) for mean, _, n in blocks]) if blocks else np.empty(0)


def _knots(raw: np.ndarray, weights: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and value of each flat part of the isotonic fit; scores between are interpolated."""
    fit = isotonic(weights, means)
    values, first = np.unique(fit, return_index=True)
    ends = np.append(first[1:], len(fit))
    centres = np.array([np.average(raw[a:b], weights=weights[a:b]) for a, b in zip(first, ends)])
    return centres, values


@dataclass
class Model:
    features: Features | None
    weights: np.ndarray | None
    centres: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights if self.weights is not None else np.zeros(len(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.centres, self.values), 0.0, 1.0)


def _raw_scores(model: Model):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column(1)], ["raw", "y"])

    return of_batches


def fit(statistics: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fold 0 is never used; folds 1 to 3 fit the ridge, fold 4 calibrates it."""
    known = labels.select(labels["doc_id"].alias("l_id"), labels["quality"].cast("double").alias("y")).where(
        "l_id is not null and y is not null"
    )
    fold = fold_of(F.col("l_id"))
    usable = known.withColumn("fold", fold).where(F.col("fold") != HELD_OUT)
    total = usable.count()
    if total > settings.most_labels:
        cut = int(settings.most_labels / total * (1 << 20))
        usable = usable.where(F.pmod(F.xxhash64("l_id"), F.lit(1 << 20)) < cut)
    rows = stored(
        statistics.join(usable, statistics[ID] == usable["l_id"]).select("x", "y", "fold"), "labelled-statistics"
    )
    training = rows.where(F.col("fold") != CALIBRATION)
    n = len(STATISTICS)
    spread = training.select(*[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(n)]).agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(n)], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(n)]
    ).first()
    if spread["m0"] is None:
        return Model(None, None, np.zeros(1), np.full(1, 0.5))
    features = Features(
        np.array([spread[f"m{i}"] for i in range(n)]), np.array([spread[f"s{i}"] or 1.0 for i in range(n)]), settings
    )
    parts = map_arrow(training.select("x", "y").repartition(settings.tasks), _summed(features), "part binary").collect()
    size = settings.features + 1
    sums = sum(np.frombuffer(part["part"]).reshape(size, size + 1) for part in parts)
    count = sums[-1, size - 1]
    weights = np.linalg.solve(sums[:, :size] + settings.ridge * count * np.eye(size) / size, sums[:, size])
    model = Model(features, weights, np.zeros(1), np.full(1, 0.5))

    calibration = rows.where(F.col("fold") == CALIBRATION)
    calibration = calibration if not calibration.isEmpty() else training
    binned = (
        map_arrow(calibration.select("x", "y"), _raw_scores(model), "raw double, y double")
        .groupBy(F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * settings.bins).alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()
    )
    raw, y, n_rows = (np.array([row[name] for row in binned], float) for name in ("raw", "y", "n"))
    model.centres, model.values = _knots(raw, n_rows, y)
    return model


def _scored(model: Model, threshold: float):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype("i4"), pa.int32())],
                [ID, "score", "predicted"],
            )

    return of_batches


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` from 0 to 1 (higher: better), ``predicted``.

    The texts are read once; the statistics, a few numbers each, are stored.
    Ids, languages, sources and labels are no inputs.  Null and empty texts have
    the statistics of the empty text and get a score; null ids are scored and
    not held out; equal rows get equal scores; repeated labels all count; null
    labels do not.  Without labels every score is 0.5.  An empty table gives no
    rows; further columns are not read.
    """
    statistics = stored(
        map_arrow(
            docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), _statistics, f"{ID} long, x array<double>"
        ),
        "document-statistics",
    )
    model = fit(statistics, labels, settings)
    scored = map_arrow(
        statistics, _scored(model, settings.threshold), f"{ID} long, score double, predicted int"
    )
    return scored.select(
        F.col(ID).alias("doc_id"),
        F.coalesce(fold_of(F.col(ID)) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )

"""Toxicity by a classifier chain: linear models on words, each fed with the earlier categories' probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ID, TEXT_HASH, stored, text_of

TERM = "([\\p{L}\\p{M}\\p{N}]+)"
CATEGORIES = ("toxic", "toxic_prose", "toxic_junk")


@dataclass(frozen=True)
class Settings:
    """``most_labels`` bounds the labelled rows of each class, drawn by hash; ``terms`` is the size of the vocabulary,
    the words that tell the classes apart best, with a chi-square of ``least_chi`` and in ``least_documents`` of them; ``folds`` for the
    probabilities a later model learns from; a document is toxic from a probability of
    ``threshold`` of the first category on, the best on held-out labels."""

    most_labels: int = 5_000
    terms: int = 2_000
    least_documents: int = 3
    least_chi: float = 15.0
    folds: int = 3
    penalty: float = 1e-3
    steps: int = 300
    threshold: float = 0.2


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), 1))


def labelled(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Id, the categories and the distinct words of a bounded number of labelled documents.

    A toxic document is one of prose or junk by its quality label, of neither without one.
    """
    known = labels.select(
        labels["doc_id"].alias("l_id"), labels["toxic"].cast("int").alias("toxic"), labels["quality"].cast("int").alias("quality")
    ).where("l_id is not null and toxic is not null")
    counts = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("l_id"), F.lit(1 << 20))
    drawn = F.lit(False)
    weight = F.lit(1.0)
    for value, n in counts.items():
        part = min(1.0, settings.most_labels / n)
        drawn = drawn | ((F.col("toxic") == value) & (place < int(part * (1 << 20))))
        weight = F.when(F.col("toxic") == value, F.lit(1 / part)).otherwise(weight)
    rows = known.where(drawn).withColumn("weight", weight)
    texts = docs.select(docs["doc_id"].alias(ID), text_of(docs).alias("text"))
    # At most ``most_labels`` rows of each class: a bounded table.
    joined = texts.join(F.broadcast(rows), texts[ID] == rows["l_id"])
    return joined.select(
        ID,
        "weight",
        F.col("toxic").alias("toxic"),
        F.coalesce(F.col("toxic") * F.col("quality"), F.lit(0)).alias("toxic_prose"),
        F.coalesce(F.col("toxic") * (1 - F.col("quality")), F.lit(0)).alias("toxic_junk"),
        _terms(F.col("text")).alias("terms"),
    )


def vocabulary(rows: DataFrame, settings: Settings) -> list[str]:
    """The words with the largest chi-square of word and class, ties in alphabetical order."""
    totals = rows.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, n = float(totals["bad"] or 0), float(totals["n"])
    found = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("with")
    )
    a, has = F.col("a"), F.col("with")
    chance = a * (n - bad) - (has - a) * bad
    chi = chance * chance * n / (has * F.greatest(F.lit(n) - has, F.lit(1)) * max(bad * (n - bad), 1.0))
    top = found.where((has >= settings.least_documents) & (chi >= settings.least_chi)).orderBy(F.round(chi, 6).desc(), "term").limit(settings.terms)
    return [row["term"] for row in top.collect()]


class Rows:
    """A sparse 0/1 matrix."""

    def __init__(self, lists: list[list[int]], width: int):
        self.columns = np.array([c for own in lists for c in own], int)
        self.rows = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
        self.shape = (len(lists), width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.shape[0])

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, values[self.rows], self.shape[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: Rows, more: np.ndarray, y: np.ndarray, weight: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the words and of the dense columns (the last one constant), by accelerated gradient steps."""
    total = max(weight.sum(), 1e-9)
    words, dense = np.zeros(x.shape[1]), np.zeros(more.shape[1])
    ahead = (words, dense)
    step = 0.5
    for n in range(settings.steps):
        error = weight * (_sigmoid(x.times(ahead[0]) + more @ ahead[1]) - y) / total
        # Each coordinate in its own scale: rare words learn as fast as frequent ones.
        seen = x.transposed_times(weight / total) + 1e-3
        new_words = ahead[0] - step * (x.transposed_times(error) + settings.penalty * seen * ahead[0]) / seen
        new_dense = ahead[1] - step * (more.T @ error)
        drift = n / (n + 3)
        ahead = (new_words + drift * (new_words - words), new_dense + drift * (new_dense - dense))
        words, dense = new_words, new_dense
    return words, dense


@dataclass
class Chain:
    """Per category: weights of the vocabulary, of the earlier probabilities, and the constant."""

    terms: list[str]
    words: list[np.ndarray]
    dense: list[np.ndarray]


def fit_chain(rows: DataFrame, settings: Settings = Settings()) -> Chain:
    """Later models learn from out-of-fold probabilities of the earlier categories."""
    terms = vocabulary(rows, settings)
    place = {term: i for i, term in enumerate(terms)}
    wanted = F.array(*[F.lit(term) for term in terms]).cast("array<string>")
    # Words outside the bounded vocabulary stay on the executors.
    local = rows.select(
        "weight", *CATEGORIES, F.pmod(F.xxhash64(ID), F.lit(settings.folds)).alias("fold"), F.array_intersect("terms", wanted).alias("terms")
    ).collect()
    lists = [[place[term] for term in row["terms"]] for row in local]
    weight = np.array([row["weight"] for row in local], float)
    fold = np.array([row["fold"] for row in local], int)
    x_all = Rows(lists, len(terms))
    earlier = np.empty((len(local), 0))
    chain = Chain(terms, [], [])
    for category in CATEGORIES:
        y = np.array([row[category] for row in local], float)
        more = np.hstack([earlier, np.ones((len(local), 1))])
        words, dense = logistic(x_all, more, y, weight, settings)
        chain.words.append(words)
        chain.dense.append(dense)
        out_of_fold = np.zeros(len(local))
        for part in range(settings.folds):
            inside, outside = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
            w, d = logistic(Rows([lists[i] for i in inside], len(terms)), more[inside], y[inside], weight[inside], settings)
            out_of_fold[outside] = _sigmoid(Rows([lists[i] for i in outside], len(terms)).times(w) + more[outside] @ d)
        earlier = np.hstack([earlier, out_of_fold[:, None]])
    return chain


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: id, the probability of each category, and ``toxic``.

    Whole texts are scored by joins with the bounded vocabulary, without Python.
    Null and empty texts have no words and get the models' constants; null ids
    are scored like others; equal rows are one document with one score each;
    without labels every probability is 0.5 and nothing is toxic.  An empty
    table gives no rows; further columns are not read.
    """
    rows = stored(labelled(docs, labels, settings), "labelled-terms")
    empty = rows.isEmpty()
    chain = Chain([], [np.zeros(0)] * 3, [np.zeros(i + 1) for i in range(3)]) if empty else fit_chain(rows, settings)
    spark = docs.sparkSession
    # The empty word is in every row once: its sum counts equal rows, which share a group.
    weights = spark.createDataFrame(
        [("", 1, *[0.0] * len(CATEGORIES))]
        + [(term, 0, *[float(w[i]) for w in chain.words]) for i, term in enumerate(chain.terms)],
        "term string, rows int, " + ", ".join(f"w_{c} double" for c in CATEGORIES),
    )
    words = F.explode(F.array_append(_terms(text_of(docs)), F.lit("")))
    found = docs.select(docs["doc_id"].alias(ID), F.xxhash64(docs["text"]).alias(TEXT_HASH), words.alias("term"))
    # The vocabulary is bounded; sums are made before the shuffle, a row per document.
    scored = (
        found.join(F.broadcast(weights), "term")
        .groupBy(ID, TEXT_HASH)
        .agg(F.sum("rows").alias("rows"), *[F.sum(f"w_{c}").alias(f"z_{c}") for c in CATEGORIES])
        .withColumns({f"z_{c}": F.col(f"z_{c}") / F.col("rows") for c in CATEGORIES})
    )
    for n, category in enumerate(CATEGORIES):
        z = F.col(f"z_{category}") + float(chain.dense[n][-1])
        for earlier, weight in zip(CATEGORIES, chain.dense[n][:-1]):
            z = z + F.col(f"p_{earlier}") * float(weight)
        scored = scored.withColumn(f"p_{category}", 1 / (1 + F.exp(-z)))
    every = scored.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return every.select(
        F.col(ID).alias("doc_id"),
        *[f"p_{category}" for category in CATEGORIES],
        ((F.col("p_toxic") >= settings.threshold) & F.lit(not empty)).alias("toxic"),
    )

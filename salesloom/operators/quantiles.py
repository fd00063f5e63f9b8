"""Exact quantiles of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor, isfinite

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.counting import counts_by_value
from salesloom.operators.ordering import SINGLE_TASK_ROWS, running_totals

# Histogram bins of a bracket, and the accuracy of the sketch that sets the brackets.
BINS = 1024
ACCURACY = 1000


@dataclass(frozen=True)
class _Brackets:
    """Ranges of one column in rising order, each cut into bins; what lies between them is a bin of its own."""

    column: str
    size: int
    ranges: tuple[tuple[float, float], ...]


def _brackets(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> tuple[list[_Brackets], list[str]]:
    """Brackets around the quantiles of each column from one scan, and the columns with values that are not finite."""
    slack = 2.0 / ACCURACY
    edges = sorted({min(max(p + s, 0.0), 1.0) for p in probabilities for s in (-slack, slack)})
    parts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        parts += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
            F.percentile_approx(value, edges, ACCURACY).alias(f"edges{i}"),
        ]
    row = df.agg(*parts).first()
    found, wild = [], []
    for i, c in enumerate(columns):
        if not row[f"n{i}"]:
            continue
        if not (isfinite(row[f"low{i}"]) and isfinite(row[f"high{i}"])):
            wild.append(c)
            continue
        at = dict(zip(edges, row[f"edges{i}"]))
        ranges: list[tuple[float, float]] = []
        for p in sorted(set(probabilities)):
            low, high = at[min(max(p - slack, 0.0), 1.0)], at[min(max(p + slack, 0.0), 1.0)]
            if ranges and low <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(ranges[-1][1], high))
            else:
                ranges.append((low, high))
        found.append(_Brackets(c, row[f"n{i}"], tuple(ranges)))
    return found, wild


def _bin(brackets: Sequence[_Brackets], bins: int) -> Column:
    """A number that rises with ``value`` in the column numbered ``at``, by which a value is found in the histogram."""

    def of_column(values: list) -> Column:
        return F.get(F.array(*[F.lit(v).cast("double") for v in values]), F.col("at"))

    value, out, step = F.col("value"), None, bins + 3
    for i in range(max(len(b.ranges) for b in brackets)):
        # A column with fewer ranges has NULL here, and no value compares with it.
        low, high = (of_column([b.ranges[i][end] if i < len(b.ranges) else None for b in brackets]) for end in (0, 1))
        inside = F.when(low == high, F.lit(0)).otherwise(F.width_bucket(value, low, high, F.lit(bins)))
        below, within = F.lit(i * step), F.lit(i * step + 1) + inside.cast("int")
        out = F.when(value < low, below) if out is None else out.when(value < low, below)
        out = out.when(value <= high, within)
    above = F.get(F.array(*[F.lit(len(b.ranges) * step) for b in brackets]), F.col("at"))
    return out.otherwise(above)


def _binned(df: DataFrame, brackets: Sequence[_Brackets], bins: int) -> DataFrame:
    """``(at, bin, value)`` of every value, with the number of its column.

    Values come first, one expression for all columns then finds the bins:
    spelled out per column, the code is too long to be compiled.
    """
    pairs = [
        F.struct(F.lit(i).alias("at"), F.col(f"`{b.column}`").cast("double").alias("value")) for i, b in enumerate(brackets)
    ]
    values = df.select(F.inline(F.array(*pairs))).where("value is not null")
    return values.select("at", _bin(brackets, bins).alias("bin"), "value")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    single_task_rows: int = SINGLE_TASK_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """Exact interpolated quantiles: rows ``(column_name, probability, quantile)``.

    Three scans: a sketch brackets each quantile, a histogram of the brackets
    tells in which bin its two neighbours lie, and only the values of these bins
    are counted and sorted.  The sketch need not be right: a neighbour outside
    all brackets is found in the bin between them.  Columns with values that are
    not finite are counted by value as a whole; columns without values give no rows.
    """
    brackets, wild = _brackets(df, columns, probabilities)
    shape = "at int, column_name string, probability double, low_rank long, high_rank long, weight double"
    wanted = [
        (i, b.column, float(p), floor((b.size - 1) * p), ceil((b.size - 1) * p), (b.size - 1) * p - floor((b.size - 1) * p))
        for i, b in enumerate(brackets)
        for p in probabilities
    ]
    whole = _by_counting(df, wild, probabilities, single_task_rows) if wild else None
    if not brackets:
        return whole if whole is not None else df.sparkSession.createDataFrame([], "column_name string, probability double, quantile double")

    # At most `bins` and a few rows per quantile and column.
    histogram = _binned(df, brackets, bins).groupBy("at", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("at").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    targets = df.sparkSession.createDataFrame(wanted, shape)

    def holds(rank: str) -> Column:
        return (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("n"))

    chosen = placed.join(F.broadcast(targets), "at").where(holds("low_rank") | holds("high_rank"))
    # Two bins per quantile and column.
    found = chosen.select("at", "bin", "before").distinct().collect()
    picked = df.sparkSession.createDataFrame(found, "at int, bin int, before long")
    values = (
        _binned(df, brackets, bins)
        .join(F.broadcast(picked), ["at", "bin"])
        .groupBy("at", "bin", "before", "value")
        .agg(F.count("*").alias("n"))
    )
    upto = running_totals(values, ["value"], "n", "upto", ["at", "bin"], single_task_rows=single_task_rows)
    ranked = upto.withColumn("before", F.col("before") + F.col("upto") - F.col("n"))
    hits = ranked.join(F.broadcast(targets), "at").where(holds("low_rank") | holds("high_rank"))
    neighbours = hits.groupBy("column_name", "probability").agg(
        F.max(F.when(holds("low_rank"), F.col("value"))).alias("low"),
        F.max(F.when(holds("high_rank"), F.col("value"))).alias("high"),
        F.first("weight").alias("weight"),
    )
    quantile = F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")
    out = neighbours.select("column_name", "probability", quantile.alias("quantile"))
    return out if whole is None else out.unionByName(whole)


def _by_counting(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], single_task_rows: int
) -> DataFrame:
    """Quantiles from running counts over all values, for values that no histogram can hold."""
    sizes = df.select(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "size"
    )
    targets = (
        sizes.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("position", (F.col("size") - 1) * F.col("probability"))
        .withColumn("lower", F.floor("position"))
        .withColumn("upper", F.ceil("position"))
    )
    counts = counts_by_value(df, columns, "double").where(F.col("value").isNotNull())
    upto = running_totals(counts, ["value"], "n", "upto", ["column_name"], single_task_rows=single_task_rows)

    def covers(rank: str) -> Column:
        return (F.col("upto") - F.col("n") <= F.col(rank)) & (F.col(rank) < F.col("upto"))

    # One target per column and probability.
    hits = upto.join(F.broadcast(targets), "column_name").where(covers("lower") | covers("upper"))
    neighbours = hits.groupBy("column_name", "probability").agg(
        F.max(F.when(covers("lower"), F.col("value"))).alias("low"),
        F.max(F.when(covers("upper"), F.col("value"))).alias("high"),
        F.first(F.col("position") - F.col("lower")).alias("weight"),
    )
    quantile = F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")
    return neighbours.select("column_name", "probability", quantile.alias("quantile"))

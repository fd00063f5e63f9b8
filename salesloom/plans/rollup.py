"""Measure totals of the fact by dimension attributes."""

from __future__ import annotations

from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import TOTALS
from salesloom.operators.facts import YEAR_COLUMN
from salesloom.operators.ordering import bounded_broadcast
from salesloom.plans.cubes import covering, cube_rollup
from salesloom.plans.warehouse import Star

DIM_KEYS = {
    "dim_date": "date_key",
    "dim_product": "product_key",
    "dim_segment": "segment_key",
    "dim_geography": "geography_key",
    "dim_discount": "discount_key",
}
# Up to this many groups per task, days are grouped as they are and meet the calendar later.
DAY_GROUPS = 200_000
# Small measures are below 10**6; that many of them stay below 10**16.
MOST_LINES = 10**10


def fact_lines(star: Star, clean: bool = True) -> DataFrame:
    """The fact, without quarantined rows if ``clean``."""
    return star.fact.where(~F.col("has_missing_keys")) if clean else star.fact


def sums_fit(star: Star) -> bool:
    """Whether no sum of small measures over the whole fact can leave decimal(18,2)."""
    return star.lines() < MOST_LINES


def task_sums(star: Star, lines: DataFrame, totals: Sequence[str]) -> tuple[DataFrame, list[str], list[Column]]:
    """``lines``, further columns to group them by, and the sums to take per group.

    A sum over decimal(8,2) runs on a plain long, several times faster than on
    decimal(18,2); the cast is only used for measures known to fit.  Its limit
    is 10**16, which fewer than 10**10 such rows cannot reach.  Above that rows
    are grouped by task as well, which keeps each sum far below the limit, and
    ``whole_sums`` adds the task sums in full precision.
    """

    def amount(measure: str) -> Column:
        return F.col(measure).cast("decimal(8,2)") if star.is_small(measure) else F.col(measure)

    sums = [F.sum(amount(TOTALS[t])).cast("decimal(28,2)").alias(t) for t in totals]
    if sums_fit(star):
        return lines, [], sums
    return lines.withColumn("_task", F.spark_partition_id()), ["_task"], sums


def whole_sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _calendar(star: Star, lines: DataFrame, days: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Join calendar attributes to fact rows; the calendar is bounded, so it is broadcast."""
    wanted = ["date_key", *attributes]
    if YEAR_COLUMN not in lines.columns:
        return lines.join(bounded_broadcast(days.select(*wanted), star.size("dim_date")), "date_key")
    # The same year on both sides lets a calendar filter prune fact partitions.
    dated = days.select(*wanted, F.col("year").alias(YEAR_COLUMN))
    return lines.join(bounded_broadcast(dated, star.size("dim_date")), ["date_key", YEAR_COLUMN])


def _distinct_rollup(star, lines, dims, by, totals, count, rows) -> DataFrame:
    """Without known repeats: join everything, then sum and count distinct ids exactly."""
    for name, dim in dims.items():
        lines = lines.join(bounded_broadcast(dim, star.size(name)), DIM_KEYS[name])
    sums = [F.sum(TOTALS[t]).alias(t) for t in totals]
    counts = [F.count_distinct("transaction_id").alias(count)] if count else []
    counts += [F.count("*").alias(rows)] if rows else []
    return lines.groupBy(*by).agg(*sums, *counts)


def rollup(
    star: Star,
    via: Sequence[str],
    by: Sequence[str],
    totals: Sequence[str] = tuple(TOTALS),
    count: str | None = "transaction_count",
    where: dict[str, Column] | None = None,
    clean: bool = True,
    rows: str | None = None,
) -> DataFrame:
    """Sum ``totals`` and count distinct transactions per ``by``, an inner star join over ``via``.

    The fact is added up by its keys first and only the small result meets the
    dimensions, so neither their size nor a hot key matters.  Distinct
    transactions are rows less the stored surplus rows.  ``where`` filters a
    dimension before its join; a filtered calendar is joined first and prunes
    year partitions.  Where a cube of the star has the keys, it is summed in
    place of the fact.  ``clean`` leaves quarantined rows out; ``rows`` names a plain row count.
    """
    where = where or {}
    cube = covering(star.cubes, via, by, where, star.dims)
    if cube is not None:
        return cube_rollup(star, cube, via, by, totals, count, where, clean, rows)
    dims = {name: star.dims[name].where(where[name]) if name in where else star.dims[name] for name in via}
    lines = fact_lines(star, clean)
    if star.repeats is None:
        return _distinct_rollup(star, lines, dims, by, totals, count, rows)

    surplus = None
    if count:
        surplus = star.repeats.where(~F.col("has_missing_keys")) if clean else star.repeats
        surplus = surplus.withColumn(count, -F.col("surplus"))
    keys = [DIM_KEYS[name] for name in via]
    late_days, attributes = None, []
    if "dim_date" in dims:
        days = dims.pop("dim_date")
        attributes = [c for c in by if c in days.columns and c != "date_key"]
        if "dim_date" in where or star.size("dim_date") * prod(map(star.size, dims)) > DAY_GROUPS:
            lines = _calendar(star, lines, days, attributes)
            keys = [k for k in keys if k != "date_key"] + attributes
            if surplus is not None:
                surplus = _calendar(star, surplus, days, attributes)
        else:
            late_days = days

    counted = [n for n in (count, rows) if n]
    names = [*totals, *counted]
    tasked, by_task, sums = task_sums(star, lines, totals)
    # Surplus rows are lines that count less than nothing: one shuffle adds up both.
    measures = list(dict.fromkeys(TOTALS[t] for t in totals))
    fed = tasked.select(*keys, *by_task, *measures, *[F.lit(1).cast("long").alias(n) for n in counted])
    if surplus is not None:
        fed = fed.unionByName(surplus.select(*keys, count), allowMissingColumns=True)
    partial = fed.groupBy(*keys, *by_task).agg(*sums, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counted])
    partial = partial.select(*keys, *names)
    if late_days is not None:
        partial = _calendar(star, partial, late_days, attributes)
        keys = [k for k in keys if k != "date_key" or k in by] + attributes
    small = partial
    if by_task or late_days is not None:
        small = partial.groupBy(*keys).agg(*whole_sums(names))
    for name, dim in dims.items():
        wanted = [c for c in by if c in dim.columns and c != DIM_KEYS[name]]
        small = small.join(dim.select(DIM_KEYS[name], *wanted), DIM_KEYS[name])
    if set(keys) <= set(by):
        return small.select(*by, *names)
    return small.groupBy(*by).agg(*whole_sums(names))

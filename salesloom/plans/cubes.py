"""Totals of the fact by month and by product, kept beside it, from which reports are made.

Both are side tables of the fact: a merge adds and takes away the totals of the
rows it changed, so a report after a merge reads neither the fact nor a year
that did not change.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.dates import calendar_columns
from salesloom.functions.measures import TOTALS
from salesloom.operators.merging import Side

# Attributes of the calendar that all days of a month share.
MONTH_ATTRIBUTES = ("year", "quarter", "month_number", "month_name")
MONTH = "month_key"
ROWS = "lines"

# cube -> dimension -> key column in the cube
CUBES = {
    "product": {"dim_product": "product_key", "dim_segment": "segment_key", "dim_discount": "discount_key"},
    "calendar": {
        "dim_date": MONTH, "dim_segment": "segment_key", "dim_geography": "geography_key", "dim_discount": "discount_key",
    },
}


def month_of(date_key: Column) -> Column:
    """The key of the first day of the month, whether or not the calendar has that day."""
    return (F.floor(date_key / 100) * 100 + 1).cast("int")


def month_attributes(names: Sequence[str]) -> list[Column]:
    columns = calendar_columns(F.to_date(F.col(MONTH).cast("string"), "yyyyMMdd"), (5, 6))
    return [columns[name].alias(name) for name in names]


def cube_rows(fact: DataFrame, whole: bool = True, *, name: str) -> DataFrame:
    """Sums of all measures and the number of lines per combination of the cube's keys."""
    keyed = fact.withColumn(MONTH, month_of(F.col("date_key")))
    sums = [F.sum(measure).cast("decimal(28,2)").alias(total) for total, measure in TOTALS.items()]
    # A sum of no values differs from a sum of zero: the numbers of values are kept as well.
    present = [F.count(measure).alias(f"{total}_values") for total, measure in TOTALS.items()]
    zero = F.lit(0).cast("decimal(28,2)")
    grouped = keyed.groupBy(*CUBES[name].values(), "has_missing_keys").agg(*sums, *present, F.count("*").alias(ROWS))
    return grouped.withColumns({total: F.coalesce(total, zero) for total in TOTALS})


SIDES = tuple(
    Side(f"cube_{name}", partial(cube_rows, name=name), (*TOTALS, *[f"{t}_values" for t in TOTALS], ROWS)) for name in CUBES
)


def covering(cubes: dict[str, DataFrame], via: Sequence[str], by: Sequence[str], where: dict, dims: dict[str, DataFrame]) -> str | None:
    """The cube from which totals over ``via`` can be made, if there is one."""
    if "dim_date" in where or "date_key" in by:
        return None
    if "dim_date" in via:
        other = {c for name in via if name != "dim_date" for c in dims[name].columns}
        if any(c not in MONTH_ATTRIBUTES and c not in other for c in by):
            return None
    return next((name for name, keys in CUBES.items() if name in cubes and set(via) <= set(keys)), None)


def cube_rollup(
    star,
    name: str,
    via: Sequence[str],
    by: Sequence[str],
    totals: Sequence[str],
    count: str | None,
    where: dict[str, Column],
    clean: bool,
    rows: str | None,
) -> DataFrame:
    """What ``rollup`` gives, from a cube and the surplus of repeated ids."""
    lines, surplus = star.cubes[name], star.repeats
    if clean:
        lines, surplus = lines.where(~F.col("has_missing_keys")), surplus.where(~F.col("has_missing_keys"))
    attributes = [c for c in by if c in MONTH_ATTRIBUTES] if "dim_date" in via else []
    keys = [CUBES[name][dim] for dim in via if dim != "dim_date"]
    dated = [MONTH] if "dim_date" in via else []
    counted = [n for n in (count, rows) if n]
    measured = [c for total in totals for c in (total, f"{total}_values")] + ["_lines"]
    lines = lines.withColumn("_lines", F.col(ROWS))
    partial_sums = lines.groupBy(*keys, *dated).agg(
        *[F.sum(c).alias(c) for c in measured], *[F.sum(ROWS).alias(n) for n in counted]
    )
    if count:
        less = surplus.withColumn(MONTH, month_of(F.col("date_key"))).select(*keys, *dated, (-F.col("surplus")).alias(count))
        partial_sums = partial_sums.unionByName(less, allowMissingColumns=True)
    if dated:
        partial_sums = partial_sums.where(F.col(MONTH).isNotNull())
    sums = partial_sums.select(*keys, *month_attributes(attributes), *measured, *counted)
    sums = sums.groupBy(*keys, *attributes).agg(*[F.sum(c).alias(c) for c in [*measured, *counted]])
    for dim in via:
        if dim == "dim_date":
            continue
        key = CUBES[name][dim]
        members = star.dims[dim].where(where[dim]) if dim in where else star.dims[dim]
        sums = sums.join(members.select(key, *[c for c in by if c in members.columns and c != key]), key)
    whole = sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in [*measured, *counted]])
    known = {t: F.when(F.col(f"{t}_values") > 0, F.col(t)) for t in totals}
    # Groups that a merge has emptied are gone.
    return whole.where("_lines > 0").select(*by, *[known[t].cast("decimal(38,2)").alias(t) for t in totals], *counted)


def with_cubes(star):
    """The star with cubes made from its fact, each in one scan and stored for this session."""
    from dataclasses import replace

    from salesloom.session import checkpointed

    return replace(star, cubes={name: checkpointed(cube_rows(star.fact, name=name)) for name in CUBES})

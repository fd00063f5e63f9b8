"""Row numbers, running totals and bounded lookups that do not depend on one task.

A window without a partition, or over one big group, sorts everything in a
single task.  That is the right plan for a small frame; above
``SINGLE_TASK_ROWS`` the same numbers come from a range-partitioned sort plus
one offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import checkpointed

SINGLE_TASK_ROWS = 1_000_000
BROADCAST_ROWS = 500_000


def bounded_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when it is known, or counted, to hold at most ``limit`` rows."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= limit else df


def _join_groups(df: DataFrame, grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring per-group values to the rows of each group; NULL keys are a group as well."""
    renamed = grouped.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(renamed, same).drop(*[f"_of_{k}" for k in keys])


def sorted_slices(df: DataFrame, sort: list) -> DataFrame:
    """Globally sorted rows with ``_slot``: slice number in the high bits, position in the low 33."""
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # The slices are read twice below, so they must be the same both times.
    return checkpointed(ranged).withColumn("_slot", F.monotonically_increasing_id())


def _slice_offsets(slices: DataFrame, amount: Column) -> DataFrame:
    """Total of ``amount`` in all earlier slices; one row per slice."""
    totals = slices.groupBy(F.shiftright("_slot", 33).alias("_slice")).agg(amount.alias("_amount"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_slice", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset")
    )


def row_numbers(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str,
    partition_by: Sequence[str] = (),
    rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``row_number() over (partition by … order by …)`` as bigint column ``name``.

    ``rows`` is an upper bound of the size of ``df`` if the caller knows one;
    otherwise the rows are counted.  ``order_by`` must end in a unique column.
    """
    if rows is None:
        df = checkpointed(df)
        rows = df.count()
    if rows <= single_task_rows:
        window = Window.partitionBy(*partition_by).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))

    slices = sorted_slices(df, [*[F.col(c) for c in partition_by], *order_by])
    offsets = _slice_offsets(slices, F.count("*"))
    position = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per slice: the broadcast is bounded by the number of shuffle partitions.
    numbered = (
        slices.withColumn("_slice", F.shiftright("_slot", 33))
        .join(F.broadcast(offsets), "_slice")
        .withColumn(name, (position + F.col("_offset") + 1).cast("bigint"))
        .select(*df.columns, name)
    )
    if not partition_by:
        return numbered
    first = numbered.groupBy(*partition_by).agg(F.min(name).alias("_first"))
    return _join_groups(numbered, first, partition_by).select(
        *df.columns, (F.col(name) - F.col("_first") + 1).alias(name)
    )


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    amount: str,
    name: str,
    partition_by: Sequence[str] = (),
    rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add the running sum of bigint column ``amount`` within each group as ``name``."""
    if rows is None:
        df = checkpointed(df)
        rows = df.count()
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if rows <= single_task_rows:
        window = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(*so_far)
        return df.withColumn(name, F.sum(amount).over(window))

    slices = sorted_slices(df, [*partition_by, *order_by])
    # Missing amounts add nothing, and a total is missing until the first amount of its group.
    known, present = F.coalesce(F.col(amount), F.lit(0)), F.when(F.col(amount).isNotNull(), 1).otherwise(0)
    sums = _slice_offsets(slices, F.sum(known))
    counts = _slice_offsets(slices, F.sum(present)).withColumnRenamed("_offset", "_counted")
    in_slice = Window.partitionBy("_slice").orderBy("_slot").rowsBetween(*so_far)
    summed = (
        slices.withColumn("_slice", F.shiftright("_slot", 33))
        .withColumns({"_running": F.sum(known).over(in_slice), "_seen": F.sum(present).over(in_slice)})
        .join(F.broadcast(sums), "_slice")
        .join(F.broadcast(counts), "_slice")
        .withColumns({"_running": F.col("_running") + F.col("_offset"), "_seen": F.col("_seen") + F.col("_counted")})
        .select(*df.columns, "_slot", "_running", "_seen")
    )
    if not partition_by:
        return summed.select(*df.columns, F.when(F.col("_seen") > 0, F.col("_running")).alias(name))
    # The group starts at its first place, whatever the signs of its amounts.
    first = summed.groupBy(*partition_by).agg(
        F.min_by(F.col("_running") - known, "_slot").alias("_before"),
        F.min_by(F.col("_seen") - present, "_slot").alias("_seen_before"),
    )
    return _join_groups(summed, first, partition_by).select(
        *df.columns,
        F.when(F.col("_seen") > F.col("_seen_before"), F.col("_running") - F.col("_before")).alias(name),
    )


def with_group_totals(
    df: DataFrame,
    group_by: Sequence[str],
    totals: dict[str, str],
    rows: int | None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add to each row the sum of ``totals[new]`` over its group as column ``new``.

    A window reads ``df`` once and suits pre-aggregated rows; when the groups
    could be big, a grouped copy is joined back instead.
    """
    if rows is not None and rows <= single_task_rows:
        window = Window.partitionBy(*group_by)
        return df.withColumns({new: F.sum(old).over(window) for new, old in totals.items()})
    df = checkpointed(df)
    grouped = df.groupBy(*group_by).agg(*[F.sum(old).alias(new) for new, old in totals.items()])
    return _join_groups(df, grouped, group_by)

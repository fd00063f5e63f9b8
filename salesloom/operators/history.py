"""Product history: the version valid on a day, and versions by runs of equal prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.ordering import bounded_broadcast, sorted_slices
from salesloom.session import checkpointed, release

# Groups with more than one in this many of all days are sorted over several tasks.
HOT_SHARE = 1000
# Versions of one group that are searched in the row; groups with more are sorted together with the rows.
MOST_IN_ROW = 256


def _carried(rows: DataFrame, order: Sequence[Column], value: str, sliced: bool) -> DataFrame:
    """Adds ``_last``: the last ``value`` that is not null up to the row, per ``_group`` in ``order``.

    ``sliced`` rows are of few big groups: they are sorted over all tasks, and
    what a slice ends with is carried to the next ones; else a group is sorted
    in one task.
    """
    last = F.last(value, ignorenulls=True)
    upward = (Window.unboundedPreceding, Window.currentRow)
    if not sliced:
        return rows.withColumn("_last", last.over(Window.partitionBy("_group").orderBy(*order).rowsBetween(*upward)))
    slices = sorted_slices(rows, [F.col("_group"), *order])
    slices = slices.withColumn("_slice", F.shiftright("_slot", 33))
    inside = Window.partitionBy("_group", "_slice").orderBy("_slot").rowsBetween(*upward)
    ends = slices.groupBy("_group", "_slice").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_slot"))).alias("_end")
    )
    before = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_group", "_slice", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    # A row per slice and big group: bounded by the shuffle partitions and HOT_SHARE.
    return (
        slices.join(F.broadcast(carried), ["_group", "_slice"])
        .withColumn("_last", F.coalesce(last.over(inside), F.col("_carried")))
        .drop("_slot", "_slice", "_carried")
    )


def _searched(left: DataFrame, versions: DataFrame, rows: int) -> DataFrame:
    """Brings the versions of the group to the row and takes the last that starts in time."""
    lists = versions.groupBy("_group").agg(
        F.collect_list(F.struct("_day", "_tie", "_version")).alias("_versions")
    )
    found = left.join(bounded_broadcast(lists, rows), "_group", "left")
    begun = F.filter("_versions", lambda version: version["_day"] <= F.col("_day"))
    return found.withColumn("_last", F.array_max(begun)["_version"])


def _merged(left: DataFrame, versions: DataFrame, share: int) -> DataFrame:
    """Sorts the days of a group's rows and its versions together; each day takes the last version above it.

    Rows of one group and day have the same version, so whole rows are not
    sorted: they only look up their day.
    """
    days = checkpointed(left.select("_group", "_day", "_kind").distinct())
    both = days.unionByName(versions, allowMissingColumns=True)
    counts = checkpointed(days.groupBy("_group").agg(F.count("*").alias("_days")))
    total = counts.agg(F.coalesce(F.sum("_days"), F.lit(0))).first()[0]
    # Fewer than `share` groups can have more than one in `share` of all days.
    hot = counts.where(F.col("_days") * share > total).select("_group")
    order = [F.col("_day"), F.col("_kind"), F.col("_tie").asc_nulls_first()]
    if hot.isEmpty():
        found = _carried(both, order, "_version", False)
    else:
        found = _carried(both.join(F.broadcast(hot), "_group", "left_anti"), order, "_version", False).unionByName(
            _carried(both.join(F.broadcast(hot), "_group", "left_semi"), order, "_version", True)
        )
    placed = found.where("_kind = 1").select("_group", "_day", "_last")
    release(left.sparkSession)
    return left.join(bounded_broadcast(placed, total), ["_group", "_day"])


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    group: str,
    day: str,
    start: str,
    values: Sequence[str],
    tie: Sequence[str | Column] = (),
    version_group: str | None = None,
    most_in_row: int = MOST_IN_ROW,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Each row with ``values`` of the newest version of its ``group`` that starts on its ``day`` or before.

    Where no group has more than ``most_in_row`` versions, a group's versions
    are brought to the row as a list and searched there: the rows are not
    shuffled while the lists fit the bound for broadcasts.  Else the days of a
    group's rows, each once, and its versions are laid together and sorted,
    versions first, and each day takes the last version above it; groups with
    more than one in ``share`` of all days are then sorted over several tasks.
    Rows look up their day and are not shuffled while the days fit the bound
    for broadcasts.  Neither way joins by a range.

    Of versions that start on one day the last by ``tie`` counts.  Rows before
    the first version, or without a group or day, get nulls; versions
    without a group or start count for nothing.
    """
    names = rows.columns
    packed = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.lit(True).alias("_"))
    left = rows.select(
        F.col(group).alias("_group"), F.col(day).alias("_day"), F.lit(1).alias("_kind"), packed.alias("_row")
    )
    named = F.col(version_group or group)
    right = versions.where(named.isNotNull() & F.col(start).isNotNull()).select(
        named.alias("_group"),
        F.col(start).alias("_day"),
        F.lit(0).alias("_kind"),
        F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"t{i}") for i, c in enumerate(tie)], F.lit(0).alias("_")).alias("_tie"),
        F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(values)]).alias("_version"),
    )
    right = checkpointed(right)
    sizes = right.groupBy("_group").agg(F.count("*").alias("_n")).agg(F.sum("_n"), F.max("_n")).first()
    findable = F.col("_group").isNotNull() & F.col("_day").isNotNull()
    if (sizes[1] or 0) <= most_in_row:
        placed, lost = _searched(left, right, sizes[0] or 0), None
    else:
        placed, lost = _merged(left.where(findable), right, share), left.where(~findable)
    kinds = {f.name: f.dataType for f in versions.select(*values).schema}
    unpacked = [F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)]
    out = placed.select(*unpacked, *[F.col(f"_last.v{i}").alias(c) for i, c in enumerate(values)])
    if lost is None:
        return out
    return out.unionByName(lost.select(*unpacked, *[F.lit(None).cast(kinds[c]).alias(c) for c in values]))


def daily_prices(staged: DataFrame) -> DataFrame:
    """One price per product and day: the one of most lines, of equally many the lowest, a missing one last.

    Grouped by product, day and price first, so a product sold on every line
    costs a row per task, day and price.
    """
    counted = (
        staged.where(F.col("product_name").isNotNull() & F.col("transaction_date").isNotNull())
        .groupBy("product_name", "transaction_date", "manufacturing_price")
        .agg(F.count("*").alias("_lines"))
    )
    # The greatest struct wins: most lines, then a known price, then the lowest.
    rank = F.struct("_lines", F.col("manufacturing_price").isNotNull(), -F.col("manufacturing_price"))
    return counted.groupBy("product_name", "transaction_date").agg(
        F.max_by("manufacturing_price", rank).alias("manufacturing_price")
    )


def change_runs(staged: DataFrame) -> DataFrame:
    """Versions by runs of equal daily prices: a price that comes back is a version of its own.

    Columns: ``product_name``, ``version_number`` within the product (from 1),
    ``manufacturing_price``, ``effective_date`` (first day of the run),
    ``end_date`` (the day before the next run, null for the last), ``days``
    with sales in the run, and ``is_current``.

    A product has at most as many rows here as the calendar has days, whatever
    its number of lines, so a window over a product is bounded.
    """
    days = daily_prices(staged)
    in_product = Window.partitionBy("product_name").orderBy("transaction_date")
    before = F.lag(F.struct("manufacturing_price")).over(in_product)
    starts = before.isNull() | ~F.col("manufacturing_price").eqNullSafe(before["manufacturing_price"])
    flagged = days.withColumn("_starts", starts.cast("int"))
    numbered = flagged.withColumn("version_number", F.sum("_starts").over(in_product).cast("bigint"))
    runs = numbered.groupBy("product_name", "version_number").agg(
        F.first("manufacturing_price").alias("manufacturing_price"),
        F.min("transaction_date").alias("effective_date"),
        F.count("*").alias("days"),
    )
    following = F.lead("effective_date").over(Window.partitionBy("product_name").orderBy("version_number"))
    return runs.withColumn("end_date", F.date_sub(following, 1)).withColumn("is_current", F.col("end_date").isNull())

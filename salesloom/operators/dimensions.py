"""Dimension builders over the staging relation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.dates import calendar_columns
from salesloom.operators.ordering import SINGLE_TASK_ROWS, bounded_broadcast, row_numbers
from salesloom.schemas import conform
from salesloom.session import checkpointed

# Region and sub-region of each known country.
REGIONS = (
    ("United States", "North America", "Northern America"),
    ("Canada", "North America", "Northern America"),
    ("Mexico", "North America", "Central America"),
    ("France", "Europe", "Western Europe"),
    ("Germany", "Europe", "Western Europe"),
    ("UK", "Europe", "Western Europe"),
    ("Italy", "Europe", "Western Europe"),
    ("Spain", "Europe", "Western Europe"),
    ("Japan", "Asia", "East Asia"),
    ("China", "Asia", "East Asia"),
    ("India", "Asia", "South Asia"),
    ("South Korea", "Asia", "East Asia"),
    ("Brazil", "South America", "Southern South America"),
    ("Argentina", "South America", "Southern South America"),
    ("Australia", "Oceania", "Australia and New Zealand"),
    ("New Zealand", "Oceania", "Australia and New Zealand"),
)

# Range and description of each discount band.
BANDS = (
    ("None", 0, 0, "No discount applied"),
    ("Low", 1, 15, "Small discount between 1-15%"),
    ("Medium", 15, 30, "Medium discount between 15-30%"),
    ("High", 30, 50, "High discount between 30-50%"),
)

# Last day of an open product version, before the one-day step back.
OPEN_END = "9999-12-31"


def date_spine(spark: SparkSession, start: str, end_exclusive: str) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end_exclusive``."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end_exclusive).cast("date"), 1)
    if date.fromisoformat(start) >= date.fromisoformat(end_exclusive):
        raise ValueError("the spine needs at least one day")
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_day"))


def dim_date(
    spark: SparkSession,
    start: str = "2010-01-01",
    end_exclusive: str = "2030-12-31",
    weekend_days: Sequence[int] = (5, 6),
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Calendar dimension.  ``holidays`` is a frame with a ``date_day`` column."""
    days = date_spine(spark, start, end_exclusive)
    if holidays is None:
        days = days.withColumn("is_holiday", F.lit(False))
    else:
        marked = holidays.select("date_day").distinct().withColumn("is_holiday", F.lit(True))
        days = days.join(marked, "date_day", "left").fillna(False, ["is_holiday"])
    columns = {**calendar_columns(F.col("date_day"), weekend_days), "is_holiday": F.col("is_holiday")}
    return conform(days.select(*[c.alias(n) for n, c in columns.items()]), schemas.DIM_DATE)


def keyed_members(
    members: DataFrame,
    natural_key: Sequence[str],
    key: str,
    order_by: Sequence[str] | None = None,
    existing: DataFrame | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Give each member a dense key in the order of ``order_by``.

    With ``existing`` (natural key and key columns of an earlier build) known
    members keep their key and new ones continue after the highest.
    """
    order_by = [F.col(c).asc_nulls_last() for c in order_by or natural_key]
    if existing is None:
        return row_numbers(members, order_by, key, single_task_rows=single_task_rows)
    # Renamed, as the members may come from the same table.
    old = existing.select(*[F.col(c).alias(f"_old_{c}") for c in natural_key], F.col(key).alias(f"_old_{key}"))
    match = F.lit(True)
    for c in natural_key:
        match = match & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    matched = members.join(old, match, "left").withColumn(key, F.col(f"_old_{key}"))
    matched = checkpointed(matched.select(*members.columns, key))
    known = matched.where(F.col(key).isNotNull())
    new = row_numbers(
        matched.where(F.col(key).isNull()).drop(key), order_by, "_n", single_task_rows=single_task_rows
    )
    top = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    return known.unionByName(new.withColumn(key, F.col("_n") + top).drop("_n"))


def _members(staged: DataFrame, column: str) -> DataFrame:
    return staged.select(column).where(F.col(column).isNotNull()).distinct()


def dim_segment(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Segments, type 1: one row per name, rebuilt in place."""
    keyed = keyed_members(
        _members(staged, "segment_name"), ["segment_name"], "segment_key", existing=existing
    )
    return conform(
        keyed.withColumns(
            {
                "segment_description": F.concat(F.lit("Business segment for "), "segment_name"),
                "created_at": F.current_timestamp(),
                "updated_at": F.current_timestamp(),
            }
        ),
        schemas.DIM_SEGMENT,
    )


def default_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "country_name string, region string, sub_region string")


def default_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        BANDS,
        "discount_band string, discount_range_min int, discount_range_max int, discount_description string",
    )


def dim_geography(
    staged: DataFrame, regions: DataFrame | None = None, existing: DataFrame | None = None
) -> DataFrame:
    """Countries with region and sub-region; a country missing in ``regions`` is ``Other``."""
    regions = default_regions(staged.sparkSession) if regions is None else regions
    keyed = keyed_members(
        _members(staged, "country_name"), ["country_name"], "geography_key", existing=existing
    )
    placed = keyed.join(bounded_broadcast(regions), "country_name", "left")
    return conform(
        placed.fillna("Other", ["region", "sub_region"]).withColumn("created_at", F.current_timestamp()),
        schemas.DIM_GEOGRAPHY,
    )


def dim_discount(
    staged: DataFrame, bands: DataFrame | None = None, existing: DataFrame | None = None
) -> DataFrame:
    """Discount bands with their percentage range; an unknown band gets 0 to 0."""
    bands = default_bands(staged.sparkSession) if bands is None else bands
    keyed = keyed_members(
        _members(staged, "discount_band"), ["discount_band"], "discount_key", existing=existing
    )
    ranged = keyed.join(bounded_broadcast(bands), "discount_band", "left")
    return conform(
        ranged.fillna(0, ["discount_range_min", "discount_range_max"])
        .fillna("Unknown discount type", ["discount_description"])
        .withColumn("created_at", F.current_timestamp()),
        schemas.DIM_DISCOUNT,
    )


def product_versions(staged: DataFrame) -> DataFrame:
    """First day of each (product, price) pair."""
    return (
        staged.where(F.col("product_name").isNotNull())
        .groupBy("product_name", "manufacturing_price")
        .agg(F.min("transaction_date").alias("effective_date"))
    )


def close_versions(
    versions: DataFrame, rows: int | None = None, single_task_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Number versions by (product, start, price) and end each one the day before the next.

    The column ``version_number`` is dense over the whole frame, so the next
    version of a product is the row one number further: a plain equi-join that
    stays even when one product owns most versions.
    """
    if rows is None:
        versions = checkpointed(versions)
        rows = versions.count()
    order = [
        F.col("product_name"),
        F.col("effective_date").asc_nulls_last(),
        F.col("manufacturing_price").asc_nulls_last(),
    ]
    numbered = row_numbers(versions, order, "version_number", rows=rows, single_task_rows=single_task_rows)
    open_end = F.lit(OPEN_END).cast("date")
    if rows <= single_task_rows:
        in_product = Window.partitionBy("product_name").orderBy("version_number")
        has_next = F.lead(F.lit(True)).over(in_product)
        following = F.lead("effective_date").over(in_product)
        linked = numbered.withColumns({"_has_next": has_next, "_next": following})
    else:
        numbered = checkpointed(numbered)
        after = numbered.select(
            (F.col("version_number") - 1).alias("version_number"),
            "product_name",
            F.col("effective_date").alias("_next"),
            F.lit(True).alias("_has_next"),
        )
        linked = numbered.join(after, ["version_number", "product_name"], "left")
    starts_next = F.when(F.col("_has_next"), F.col("_next")).otherwise(open_end)
    return linked.withColumn("end_date", F.date_sub(starts_next, 1)).drop("_has_next", "_next")


def dim_product(
    staged: DataFrame,
    existing: DataFrame | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Products, type 2: one row per (name, price) with validity interval and current flag."""
    closed = close_versions(product_versions(staged), single_task_rows=single_task_rows)
    if existing is None:
        keyed = closed.withColumnRenamed("version_number", "product_key")
    else:
        keyed = keyed_members(
            closed,
            ["product_name", "manufacturing_price"],
            "product_key",
            order_by=["version_number"],
            existing=existing,
            single_task_rows=single_task_rows,
        )
    last_day = F.date_sub(F.lit(OPEN_END).cast("date"), 1)
    return conform(
        keyed.withColumns(
            {
                "is_current": F.coalesce(F.col("end_date") == last_day, F.lit(False)),
                "created_at": F.current_timestamp(),
            }
        ),
        schemas.DIM_PRODUCT,
    )

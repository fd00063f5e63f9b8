"""Profiles of a landed or staged table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.measures import percent
from salesloom.functions.text import month_label
from salesloom.operators.counting import counts_by_value, surplus_rows
from salesloom.operators.quantiles import exact_quantiles
from salesloom.session import checkpointed

CATEGORIES = ("segment_name", "country_name", "product_name", "discount_band")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, in one pass."""
    counts = df.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; NULLs are equal."""
    return surplus_rows(df, df.columns, "duplicate_rows")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per numeric column."""
    columns = list(columns or numeric_columns(df))
    parts = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    wide = df.select(
        *[
            F.struct(*[f(F.col(f"`{c}`").cast("double")).alias(n) for n, f in parts.items()]).alias(c)
            for c in columns
        ]
    )
    long = wide.unpivot([], columns, "column_name", "s").select("column_name", "s.*")
    quartiles = (
        exact_quantiles(df, columns, (0.25, 0.5, 0.75))
        .groupBy("column_name")
        .pivot("probability", [0.25, 0.5, 0.75])
        .agg(F.first("quantile"))
        .toDF("column_name", "p25", "p50", "p75")
    )
    return long.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULLs, rows and number of columns of the table."""
    types = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)],
        "position int, column_name string, data_type string",
    )
    counts = df.select(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    ).unpivot(["_rows"], df.columns, "column_name", "null_count")
    # One row per column of the table on both sides.
    return counts.join(F.broadcast(types), "column_name").select(
        "position",
        "column_name",
        "data_type",
        "null_count",
        F.col("_rows").alias("table_rows"),
        F.lit(len(df.columns)).alias("table_columns"),
    )


def value_counts(df: DataFrame, column: str, top: int = 5) -> DataFrame:
    """The most frequent values of ``column``, ties by value; NULL is not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(top)
        .select(F.lit(column).alias("column_name"), "value", "n")
    )


def categorical_profile(df: DataFrame, columns: Sequence[str] = CATEGORIES, top: int = 5) -> DataFrame:
    """Distinct values and the most frequent ones for each column, from one scan."""
    # The counts are read twice.
    counts = checkpointed(counts_by_value(df, columns, "string").where(F.col("value").isNotNull()))
    distinct = counts.groupBy("column_name").agg(F.count("*").alias("distinct_values"))
    # A rank filter keeps only ``top`` rows per column and task before the shuffle.
    by_size = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = counts.withColumn("_rank", F.row_number().over(by_size)).where(F.col("_rank") <= top)
    return best.join(distinct, "column_name").select("column_name", "value", "n", "distinct_values")


def date_coverage(df: DataFrame) -> DataFrame:
    """First and last day, number of different months and years."""
    return df.agg(
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
        F.count_distinct("month_number").alias("months"),
        F.count_distinct("year").alias("years"),
    )


def rows_by_year(df: DataFrame) -> DataFrame:
    return df.where(F.col("year").isNotNull()).groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


def sales_trend(df: DataFrame) -> DataFrame:
    """Net sales per month under its ``YYYY-MM`` label."""
    months = df.groupBy("year", "month_number").agg(F.sum("net_sales").alias("net_sales"))
    return months.withColumn("year_month", month_label(F.col("year"), F.col("month_number"))).orderBy(
        "year", "month_number"
    )


def ranked_total(df: DataFrame, by: str, measure: str, top: int | None = None) -> DataFrame:
    """Sum of ``measure`` per ``by``, largest first."""
    totals = (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.sum(measure).alias(measure))
        .orderBy(F.desc(measure), by)
    )
    return totals if top is None else totals.limit(top)


def discount_share(df: DataFrame) -> DataFrame:
    """Discounts in percent of gross sales per band, lowest first."""
    sums = (
        df.where(F.col("discount_band").isNotNull())
        .groupBy("discount_band")
        .agg(F.sum("discounts").alias("discounts"), F.sum("gross_sales").alias("gross_sales"))
    )
    share = percent(F.col("discounts"), F.col("gross_sales"))
    return sums.withColumn("discount_pct", share).orderBy("discount_pct", "discount_band")


def repriced_products(df: DataFrame) -> DataFrame:
    """Products seen at more than one price: candidates for versioning."""
    counts = (
        df.where(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.count_distinct("manufacturing_price").alias("prices"))
    )
    return counts.where("prices > 1")


def product_prices(df: DataFrame, product: str) -> DataFrame:
    """The distinct prices of one product."""
    return df.where(F.col("product_name") == product).select("product_name", "manufacturing_price").distinct()

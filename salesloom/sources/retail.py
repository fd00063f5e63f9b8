"""Retail order tables as flat sales lines in the staging layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.schemas import MONEY, STAGING, conform


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def band_of(discount: Column) -> Column:
    return (
        F.when(discount <= 0, "None")
        .when(discount <= F.lit(0.03).cast("decimal(4,2)"), "Low")
        .when(discount <= F.lit(0.07).cast("decimal(4,2)"), "Medium")
        .otherwise("High")
    )


def country_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Region of each nation; the source has no finer sub-region, so the region repeats."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"),
        F.col("r_name").alias("sub_region"),
    )


def sales_lines(
    spark: SparkSession, folder: str, loaded_at: Column | None = None, by_year: bool = False
) -> DataFrame:
    """One staged sales line per line item.

    No join is hinted: nation fits under the size-checked broadcast threshold,
    the other sides are chosen from file sizes and split at run time if skewed.
    ``by_year`` groups the lines by sale year for a partitioned write; the few
    source columns are shuffled for that, not the many derived ones.
    """
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    item = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    buyer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    bought = orders.join(buyer, F.col("o_custkey") == F.col("c_custkey"))
    lines = item.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    if by_year:
        lines = lines.withColumn("_year", F.year("l_shipdate")).hint("rebalance", "_year")
    units, gross = F.col("l_quantity").cast(MONEY), F.col("l_extendedprice").cast(MONEY)
    rate = F.col("l_discount").cast("decimal(4,2)")
    day = F.col("l_shipdate").cast("date")
    amounts = lines.select(
        F.col("c_mktsegment").alias("segment_name"),
        F.col("n_name").alias("country_name"),
        F.col("p_name").alias("product_name"),
        band_of(rate).alias("discount_band"),
        units.alias("units_sold"),
        F.col("p_retailprice").cast(MONEY).alias("manufacturing_price"),
        F.round(
            (gross.cast("double") / F.nullif(units.cast("double"), F.lit(0.0))).cast("decimal(38,10)"), 2
        ).cast(MONEY).alias("sale_price"),
        gross.alias("gross_sales"),
        F.round(gross * rate, 2).cast(MONEY).alias("discounts"),
        day.alias("transaction_date"),
    )
    costed = amounts.withColumns(
        {
            "net_sales": (F.col("gross_sales") - F.col("discounts")).cast(MONEY),
            "cogs": F.round(F.col("units_sold") * F.col("manufacturing_price"), 2).cast(MONEY),
        }
    )
    return conform(
        costed.withColumns(
            {
                "profit": (F.col("net_sales") - F.col("cogs")).cast(MONEY),
                "month_number": F.month("transaction_date"),
                "month_name": F.date_format("transaction_date", "MMMM"),
                "year": F.year("transaction_date"),
                "load_datetime": F.current_timestamp() if loaded_at is None else loaded_at,
                "record_source": F.lit("lineitem"),
            }
        ),
        STAGING,
    )

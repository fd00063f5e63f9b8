"""Ad-hoc star queries used as benchmark, and the business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions.measures import growth_percent, percent, quotient
from salesloom.operators.counting import repeated_values
from salesloom.plans.rollup import rollup
from salesloom.plans.warehouse import Star


def _falling(column: str):
    return F.col(column).desc_nulls_first()


def fact_totals(star: Star) -> DataFrame:
    """Rows, sales and profit of the whole fact."""
    return star.fact.agg(
        F.count("*").alias("row_count"),
        F.sum("net_sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"),
        quotient(F.sum("profit"), F.count("profit")).alias("avg_profit"),
    )


def sales_by_month_name(star: Star, with_count: bool = True) -> DataFrame:
    """Sales per year and month, quarantined rows included, months in alphabetical order."""
    by = ["year", "month_name"]
    counted = "transaction_count" if with_count else None
    totals = rollup(star, ["dim_date"], by, ["net_sales", "total_profit"], None, clean=False, rows=counted)
    return _sales(totals).orderBy(*by)


def _sales(frame: DataFrame) -> DataFrame:
    return frame.withColumnRenamed("net_sales", "total_sales")


def sales_by_segment_product(star: Star, top: int = 20) -> DataFrame:
    """Sales per year, segment and product: the best of the earliest years."""
    by = ["year", "segment_name", "product_name"]
    totals = _sales(
        rollup(star, ["dim_date", "dim_segment", "dim_product"], by, ["net_sales", "total_profit"], None)
    )
    return totals.orderBy("year", _falling("total_profit"), "segment_name", "product_name").limit(top)


def country_sales_in_year(star: Star, year: int, top: int = 10) -> DataFrame:
    """Countries by profit in one year."""
    totals = _sales(
        rollup(
            star,
            ["dim_geography", "dim_date"],
            ["region", "country_name"],
            ["net_sales", "total_profit"],
            where={"dim_date": F.col("year") == year},
        )
    )
    return totals.orderBy(_falling("total_profit"), "country_name").limit(top)


def region_drill_down(star: Star, first_year: int, last_year: int, region: str, top: int = 20) -> DataFrame:
    """Six-key drill-down over five dimensions."""
    by = ["year", "quarter", "product_name", "segment_name", "region", "discount_band"]
    totals = rollup(
        star,
        ["dim_date", "dim_product", "dim_segment", "dim_geography", "dim_discount"],
        by,
        ["net_sales", "total_profit", "units_sold"],
        None,
        where={
            "dim_date": F.col("year").between(first_year, last_year),
            "dim_geography": F.col("region") == region,
        },
    )
    shaped = totals.select(
        *by,
        F.col("net_sales").alias("total_sales"),
        "total_profit",
        (quotient(F.col("total_profit"), F.col("net_sales")) * 100).alias("profit_margin"),
        F.col("units_sold").alias("total_units"),
    )
    ties = ["product_name", "segment_name", "discount_band"]
    return shaped.orderBy("year", "quarter", _falling("total_profit"), *ties).limit(top)


def effective_discounts_of_products(
    products: DataFrame,
    discounts: DataFrame,
    category: str = "High Margin",
    effectiveness: str = "Highly Effective",
    top: int = 10,
) -> DataFrame:
    """Two stored reports joined by product name."""
    left = products.where(F.col("profit_category") == category)
    right = discounts.where(F.col("discount_effectiveness") == effectiveness).select(
        "product_name", "discount_band", "segment_name", "discount_effectiveness"
    )
    return (
        left.join(right, "product_name")
        .orderBy(_falling("total_profit"), "product_name", "discount_band", "segment_name")
        .limit(top)
        .select(
            "product_name", "total_profit", "profit_margin_pct", "profit_category",
            "discount_band", "discount_effectiveness",
        )
    )


def product_segment_profit(star: Star, top: int = 10) -> DataFrame:
    """Product and segment pairs by profit."""
    by = ["product_name", "segment_name"]
    totals = _sales(rollup(star, ["dim_product", "dim_segment"], by, ["net_sales", "total_profit"], None))
    return totals.orderBy(_falling("total_profit"), *by).limit(top)


def monthly_sales_flat(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly sales of the flat table through a date lookup."""
    daily = lines.groupBy(F.col("transaction_date").alias("date_day")).agg(
        F.sum("net_sales").alias("total_sales"), F.sum("profit").alias("total_profit")
    )
    days = calendar.select("date_day", "year", "month_name", "month_number")
    return (
        daily.join(days, "date_day")
        .groupBy("year", "month_name", "month_number")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("total_profit").alias("total_profit"))
        .orderBy("year", "month_number")
    )


def monthly_sales_star(star: Star) -> DataFrame:
    """The same figures from the star."""
    by = ["year", "month_name", "month_number"]
    totals = rollup(star, ["dim_date"], by, ["net_sales", "total_profit"], None, clean=False)
    return _sales(totals).orderBy("year", "month_number")


def category_sales_flat(lines: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales per category of the flat table; lines without a category are ``Unknown``.

    ``categories`` has one row per product.  Lines are summed per product first.
    """
    sums = lines.groupBy("product_name").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("profit").alias("profit")
    )
    return _category_totals(sums.join(categories, "product_name", "left"))


def category_sales_star(star: Star, categories: DataFrame) -> DataFrame:
    """Sales per category over the current product versions of the star."""
    sums = rollup(
        star,
        ["dim_product"],
        ["product_name"],
        ["net_sales", "total_profit"],
        None,
        where={"dim_product": F.col("is_current")},
        clean=False,
    ).withColumnRenamed("total_profit", "profit")
    return _category_totals(sums.join(categories, "product_name", "left"))


def _category_totals(sums: DataFrame) -> DataFrame:
    return (
        sums.groupBy(F.coalesce("product_category", F.lit("Unknown")).alias("category"))
        .agg(F.sum("net_sales").alias("total_sales"), F.sum("profit").alias("total_profit"))
        .withColumn("profit_margin", quotient(F.col("total_profit"), F.col("total_sales")) * 100)
        .orderBy(_falling("total_sales"), "category")
    )


def country_sales_flat(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Sales and distinct transactions per region and country of the flat table.

    ``lines`` carries ``transaction_id``, which fixes the country; a country
    without a region is ``Unknown``.
    """
    # Distinct ids per country are rows less surplus copies; only hashes of the ids are shuffled.
    named = lines.where(F.col("transaction_id").isNotNull())
    copies = repeated_values(named, ["country_name", "transaction_id"])
    surplus = copies.select("country_name", (1 - F.col("_copies")).alias("transaction_count"))
    per_country = lines.groupBy("country_name").agg(
        F.sum("net_sales").alias("total_sales"), F.count("transaction_id").alias("transaction_count")
    )
    sums = (
        per_country.unionByName(surplus, allowMissingColumns=True)
        .groupBy("country_name")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("transaction_count").alias("transaction_count"))
    )
    known = regions.select("country_name", "region", F.col("country_name").alias("_known"))
    placed = sums.join(known, "country_name", "left")
    return (
        placed.groupBy(
            F.coalesce("region", F.lit("Unknown")).alias("region"),
            F.coalesce("_known", F.lit("Unknown")).alias("country"),
        )
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("transaction_count").alias("transaction_count"))
        .orderBy("region", _falling("total_sales"), "country")
    )


def country_sales_star(star: Star) -> DataFrame:
    """The same figures from the star, quarantined rows included."""
    by = ["region", "country_name"]
    totals = _sales(rollup(star, ["dim_geography"], by, ["net_sales"], clean=False))
    return totals.withColumnRenamed("country_name", "country").orderBy(
        "region", _falling("total_sales"), "country"
    )


def category_growth(star: Star, categories: DataFrame) -> DataFrame:
    """Month-over-month sales growth per product category."""
    by = ["product_name", "year", "month_number"]
    monthly = rollup(star, ["dim_product", "dim_date"], by, ["net_sales"], None)
    grouped = (
        monthly.join(categories, "product_name", "left")
        .groupBy(
            F.coalesce("product_category", F.lit("Unknown")).alias("category"), "year", "month_number"
        )
        .agg(F.sum("net_sales").alias("net_sales"))
    )
    in_category = Window.partitionBy("category").orderBy("year", "month_number")
    previous = F.lag("net_sales").over(in_category)
    return grouped.withColumn("prev_month_net_sales", previous).withColumn(
        "mom_growth_pct", growth_percent(F.col("net_sales"), F.col("prev_month_net_sales"))
    )


def declining_regions(star: Star) -> DataFrame:
    """Regions and quarters with less profit than the quarter before."""
    totals = rollup(
        star, ["dim_geography", "dim_date"], ["region", "year", "quarter"], ["total_profit"], None
    )
    in_region = Window.partitionBy("region").orderBy("year", "quarter")
    moved = totals.withColumn("prev_profit", F.lag("total_profit").over(in_region))
    return moved.withColumn("profit_change", F.col("total_profit") - F.col("prev_profit")).where(
        "profit_change < 0"
    )


def discount_effect_by_segment(star: Star) -> DataFrame:
    """Return on discounts per segment and band, ratios taken from the sums."""
    by = ["segment_name", "discount_band"]
    totals = rollup(
        star,
        ["dim_segment", "dim_discount"],
        by,
        ["gross_sales", "total_discounts", "net_sales", "total_profit"],
        None,
    )
    c = F.col
    return totals.select(
        *by,
        "gross_sales", "total_discounts", "net_sales", "total_profit",
        percent(c("total_discounts"), c("gross_sales")).alias("discount_pct"),
        percent(c("total_profit"), c("net_sales")).alias("profit_margin_pct"),
        percent(c("total_profit"), c("total_discounts")).alias("profit_per_discount_pct"),
    )


def top_product_margins(star: Star, top: int = 10) -> DataFrame:
    """Monthly margin of the products with the highest total profit."""
    by_product = rollup(star, ["dim_product"], ["product_name"], ["total_profit"], None)
    best = by_product.orderBy(_falling("total_profit"), "product_name").limit(top).select("product_name")
    by = ["product_name", "year", "month_number"]
    monthly = rollup(star, ["dim_product", "dim_date"], by, ["net_sales", "total_profit"], None)
    # ``best`` holds at most ``top`` rows.
    return monthly.join(F.broadcast(best), "product_name", "left_semi").withColumn(
        "profit_margin_pct", percent(F.col("total_profit"), F.col("net_sales"))
    )

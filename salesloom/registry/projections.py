"""Registered queries: projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.functions.measures import percent, ratio
from salesloom.operators.facts import sales_fact
from salesloom.operators.incremental import loaded_after
from salesloom.operators.profiling import product_prices
from salesloom.plans.rollup import rollup
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import on_lines, on_short_star, on_star, pct
from salesloom.registry.oracle import ratio as sql_ratio


@query(
    "prj1_rename_and_literal",
    on_star(
        "SELECT transaction_id, 'Company' AS dimension_value, CAST(net_sales AS DOUBLE) AS revenue, "
        "CAST(units_sold AS DOUBLE) AS volume, transaction_date FROM fact"
    ),
)
def prj1(spark, folder):
    return ctx.star(spark, folder).fact.select(
        "transaction_id",
        F.lit("Company").alias("dimension_value"),
        F.col("net_sales").alias("revenue"),
        F.col("units_sold").alias("volume"),
        "transaction_date",
    )


@query(
    "prj2_computed_columns",
    on_lines(
        f"SELECT product_name, {sql_ratio('sum(profit)', 'sum(units_sold)')} AS profit_per_unit, "
        f"{pct('sum(profit)', 'sum(net_sales)')} AS profit_margin_pct, "
        f"{pct('sum(discounts)', 'sum(gross_sales)')} AS discount_pct FROM lines GROUP BY 1"
    ),
)
def prj2(spark, folder):
    return ctx.staged(spark, folder).groupBy("product_name").agg(
        ratio(F.sum("profit"), F.sum("units_sold")).alias("profit_per_unit"),
        percent(F.sum("profit"), F.sum("net_sales")).alias("profit_margin_pct"),
        percent(F.sum("discounts"), F.sum("gross_sales")).alias("discount_pct"),
    )


@query(
    "prj3_typed_null_columns",
    on_lines(
        "SELECT 'segment' AS kind, segment_name AS name, CAST(sum(units_sold) AS DOUBLE) AS volume, "
        "CAST(NULL AS DOUBLE) AS discounts FROM lines GROUP BY 2 "
        "UNION ALL SELECT 'band', discount_band, CAST(NULL AS DOUBLE), CAST(sum(discounts) AS DOUBLE) "
        "FROM lines GROUP BY 2"
    ),
)
def prj3(spark, folder):
    """Two blocks padded with typed NULLs so that they line up."""
    lines = ctx.staged(spark, folder)
    segments = lines.groupBy(F.col("segment_name").alias("name")).agg(F.sum("units_sold").alias("volume"))
    bands = lines.groupBy(F.col("discount_band").alias("name")).agg(F.sum("discounts").alias("discounts"))
    absent = F.lit(None).cast("decimal(28,2)")
    left = segments.select(F.lit("segment").alias("kind"), "name", "volume", absent.alias("discounts"))
    right = bands.select(F.lit("band").alias("kind"), "name", absent.alias("volume"), "discounts")
    return left.unionByName(right)


@query(
    "prj4_chained_subqueries",
    on_star(
        """, yearly AS (SELECT g.region, d.year, sum(f.net_sales) AS sales FROM clean f
  JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1, 2),
best AS (SELECT region, max(sales) AS best_sales FROM yearly GROUP BY 1)
SELECT y.region, min(y.year) AS best_year, CAST(max(b.best_sales) AS DOUBLE) AS best_sales
FROM yearly y JOIN best b ON y.region = b.region AND y.sales = b.best_sales GROUP BY 1"""
    ),
)
def prj4(spark, folder):
    """A chain of named subqueries in SQL over temporary views."""
    rollup(
        ctx.star(spark, folder), ["dim_geography", "dim_date"], ["region", "year"], ["net_sales"], None
    ).createOrReplaceTempView("region_years")
    return spark.sql(
        "WITH yearly AS (SELECT region, year, net_sales AS sales FROM region_years), "
        "best AS (SELECT region, max(sales) AS best_sales, min_by(year, struct(-sales, year)) AS best_year "
        "FROM yearly GROUP BY region) SELECT region, best_year, best_sales FROM best"
    )


@query(
    "flt1_known_natural_key",
    on_lines("SELECT segment_name, count(*) AS n FROM lines WHERE product_name IS NOT NULL GROUP BY 1"),
)
def flt1(spark, folder):
    lines = ctx.staged(spark, folder).where(F.col("product_name").isNotNull())
    return lines.groupBy("segment_name").agg(F.count("*").alias("n"))


@query(
    "flt2_boolean_flags",
    on_short_star(
        "SELECT p.product_name, count(*) AS n FROM clean f JOIN dim_product p ON f.product_key = p.product_key "
        "WHERE p.is_current GROUP BY 1"
    ),
)
def flt2(spark, folder):
    """Resolved fact rows of current product versions, under a calendar that ends early."""
    star = ctx.short_star(spark, folder)
    counts = star.fact.where(~F.col("has_missing_keys")).groupBy("product_key").agg(F.count("*").alias("n"))
    current = star.dims["dim_product"].where("is_current").select("product_key", "product_name")
    return counts.join(current, "product_key").select("product_name", "n")


@query(
    "flt3_range_and_equality",
    on_star(
        "SELECT g.country_name, count(*) AS n, CAST(sum(f.profit) AS DOUBLE) AS profit FROM clean f "
        "JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_date d ON f.date_key = d.date_key "
        "WHERE d.year BETWEEN 1996 AND 1998 AND g.region = 'AMERICA' AND f.units_sold > 10 AND f.profit < 0 "
        "GROUP BY 1"
    ),
)
def flt3(spark, folder):
    star = ctx.star(spark, folder)
    lines = star.fact.where(
        ~F.col("has_missing_keys")
        & F.col("sale_year").between(1996, 1998)
        & (F.col("units_sold") > 10)
        & (F.col("profit") < 0)
    )
    sums = lines.groupBy("geography_key").agg(F.count("*").alias("n"), F.sum("profit").alias("profit"))
    places = star.dims["dim_geography"].where(F.col("region") == "AMERICA")
    return sums.join(places, "geography_key").select("country_name", "n", "profit")


@query(
    "flt4_in_list",
    on_lines(
        "SELECT country_name, discount_band, count(*) AS n FROM lines "
        "WHERE discount_band IN ('Low', 'High') AND segment_name IN ('BUILDING', 'MACHINERY') GROUP BY 1, 2"
    ),
)
def flt4(spark, folder):
    lines = ctx.staged(spark, folder).where(
        F.col("discount_band").isin("Low", "High") & F.col("segment_name").isin("BUILDING", "MACHINERY")
    )
    return lines.groupBy("country_name", "discount_band").agg(F.count("*").alias("n"))


@query(
    "flt5_missing_key_flag",
    on_short_star(
        "SELECT CAST(year(transaction_date) AS INTEGER) AS sale_year, has_missing_keys, count(*) AS n "
        "FROM fact GROUP BY 1, 2"
    ),
)
def flt5(spark, folder):
    """The row flag from a chain of NULL tests."""
    star = ctx.short_star(spark, folder)
    fact = sales_fact(ctx.staged(spark, folder), star.dims, star.rows)
    return fact.groupBy(F.year("transaction_date").alias("sale_year"), "has_missing_keys").agg(
        F.count("*").alias("n")
    )


@query(
    "flt6_after_high_water",
    on_lines(
        "SELECT segment_name, count(*) AS n, min(transaction_date) AS first_day FROM lines "
        "WHERE transaction_date > DATE '2000-01-01' GROUP BY 1"
    ),
)
def flt6(spark, folder):
    """Lines landed after the default start, each landed on its sales day."""
    lines = ctx.staged(spark, folder).withColumn("load_datetime", F.col("transaction_date").cast("timestamp"))
    return loaded_after(lines).groupBy("segment_name").agg(
        F.count("*").alias("n"), F.min("transaction_date").alias("first_day")
    )


@query(
    "flt7_distinct_values_of_one_key",
    on_lines(
        "SELECT DISTINCT product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price FROM lines "
        "WHERE product_name = (SELECT min(product_name) FROM lines)"
    ),
)
def flt7(spark, folder):
    """Prices of the alphabetically first product."""
    lines = ctx.staged(spark, folder)
    return product_prices(lines, lines.agg(F.min("product_name")).first()[0])

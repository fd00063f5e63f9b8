"""Registered queries: window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom.functions.measures import growth_percent
from salesloom.operators import dimensions as dm
from salesloom.operators.ordering import row_numbers
from salesloom.plans.rollup import rollup
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import growth, on_lines, on_star


@query(
    "wn1_row_number_of_members",
    on_lines(
        "SELECT country_name, row_number() OVER (ORDER BY country_name) AS geography_key "
        "FROM (SELECT DISTINCT country_name FROM lines)"
    ),
)
def wn1(spark, folder):
    members = ctx.staged(spark, folder).select("country_name").distinct()
    return row_numbers(members, ["country_name"], "geography_key")


@query(
    "wn2_row_number_two_keys",
    on_star(
        "SELECT product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, "
        "row_number() OVER (ORDER BY product_name, effective_date, manufacturing_price) AS product_key "
        "FROM product_versions"
    ),
)
def wn2(spark, folder):
    versions = dm.product_versions(ctx.staged(spark, folder))
    order = ["product_name", "effective_date", "manufacturing_price"]
    return row_numbers(versions, order, "product_key").drop("effective_date")


RANKS = {"profit_rank": "total_profit", "volume_rank": "units_sold", "revenue_rank": "net_sales"}
WN3 = on_star(
    """, r AS (SELECT p.product_name, sum(f.profit) AS total_profit, sum(f.units_sold) AS units_sold,
  sum(f.net_sales) AS net_sales FROM clean f JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1)
SELECT product_name, """
    + ", ".join(
        f"row_number() OVER (ORDER BY {m} DESC NULLS FIRST, product_name) AS {n}" for n, m in RANKS.items()
    )
    + " FROM r"
)


def _three_ranks(spark, folder, **options):
    totals = rollup(ctx.star(spark, folder), ["dim_product"], ["product_name"], list(RANKS.values()), None)
    for rank, measure in RANKS.items():
        order = [F.col(measure).desc_nulls_first(), F.col("product_name")]
        totals = row_numbers(totals, order, rank, **options)
    return totals.select("product_name", *RANKS)


@query("wn3_three_global_ranks", WN3)
def wn3(spark, folder):
    star = ctx.star(spark, folder)
    return _three_ranks(spark, folder, rows=star.size("dim_product"))


@query("wn3_three_global_ranks_distributed", WN3)
def wn3_distributed(spark, folder):
    """The same ranks by range-partitioned sorts, as for more products than fit one task."""
    return _three_ranks(spark, folder, rows=1, single_task_rows=0)


WN4 = on_star(
    """, r AS (SELECT g.country_name, g.region, d.year, sum(f.profit) AS total_profit FROM clean f
  JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1, 2, 3)
SELECT country_name, region, year,
  row_number() OVER (PARTITION BY year ORDER BY total_profit DESC NULLS FIRST, country_name) AS overall_rank,
  row_number() OVER (PARTITION BY region, year ORDER BY total_profit DESC NULLS FIRST, country_name) AS region_rank
FROM r"""
)


def _partitioned_ranks(spark, folder, **options):
    by = ["country_name", "region", "year"]
    totals = rollup(ctx.star(spark, folder), ["dim_geography", "dim_date"], by, ["total_profit"], None)
    order = [F.col("total_profit").desc_nulls_first(), F.col("country_name")]
    ranked = row_numbers(totals, order, "overall_rank", ["year"], **options)
    return row_numbers(ranked, order, "region_rank", ["region", "year"], **options).drop("total_profit")


@query("wn4_partitioned_ranks", WN4)
def wn4(spark, folder):
    return _partitioned_ranks(spark, folder)


@query("wn4_partitioned_ranks_distributed", WN4)
def wn4_distributed(spark, folder):
    """The same by one global sort and the first position of each group."""
    return _partitioned_ranks(spark, folder, rows=1, single_task_rows=0)


@query(
    "wn5_previous_period",
    on_star(
        """, q AS (SELECT d.year, d.quarter, sum(f.net_sales) AS net_sales, sum(f.profit) AS total_profit
  FROM clean f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2)
SELECT year, quarter, CAST(lag(net_sales) OVER (ORDER BY year, quarter) AS DOUBLE) AS prev_sales,
  CAST(lag(total_profit) OVER (ORDER BY year, quarter) AS DOUBLE) AS prev_profit FROM q"""
    ),
)
def wn5(spark, folder):
    quarters = rollup(
        ctx.star(spark, folder), ["dim_date"], ["year", "quarter"], ["net_sales", "total_profit"], None
    )
    # One row per calendar quarter.
    in_time = Window.orderBy("year", "quarter")
    return quarters.select(
        "year",
        "quarter",
        F.lag("net_sales").over(in_time).alias("prev_sales"),
        F.lag("total_profit").over(in_time).alias("prev_profit"),
    )


@query(
    "wn6_previous_quarter_in_year",
    on_star(
        f""", q AS (SELECT s.segment_name, d.year, d.quarter, sum(f.net_sales) AS net_sales FROM clean f
  JOIN dim_segment s ON f.segment_key = s.segment_key JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3),
l AS (SELECT *, lag(net_sales) OVER (PARTITION BY segment_name, year ORDER BY quarter) AS prev FROM q)
SELECT segment_name, year, quarter, CAST(prev AS DOUBLE) AS prev_quarter_sales,
  {growth('net_sales', 'prev')} AS qoq_growth_pct FROM l"""
    ),
)
def wn6(spark, folder):
    by = ["segment_name", "year", "quarter"]
    totals = rollup(ctx.star(spark, folder), ["dim_segment", "dim_date"], by, ["net_sales"], None)
    in_year = Window.partitionBy("segment_name", "year").orderBy("quarter")
    moved = totals.withColumn("prev_quarter_sales", F.lag("net_sales").over(in_year))
    grown = growth_percent(F.col("net_sales"), F.col("prev_quarter_sales")).alias("qoq_growth_pct")
    return moved.select(*by, "prev_quarter_sales", grown)


WN7 = on_star(
    "SELECT product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, effective_date, end_date "
    "FROM dim_product"
)


def _intervals(spark, folder, **options):
    return dm.close_versions(dm.product_versions(ctx.staged(spark, folder)), **options).drop("version_number")


@query("wn7_next_version_start", WN7)
def wn7(spark, folder):
    return _intervals(spark, folder)


@query("wn7_next_version_start_distributed", WN7)
def wn7_distributed(spark, folder):
    """The next version found by joining on the following dense number."""
    return _intervals(spark, folder, rows=1, single_task_rows=0)

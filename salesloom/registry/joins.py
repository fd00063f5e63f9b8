"""Registered queries: joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import growth_percent, percent
from salesloom.operators.facts import lookup, sales_fact
from salesloom.operators.ordering import bounded_broadcast
from salesloom.plans import adhoc
from salesloom.plans.rollup import rollup
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import growth, on_lines, on_short_star, on_star, pct
from salesloom.registry.star import DISCOUNTS, PRODUCTS
from salesloom.sources.retail import country_regions


@query(
    "jn1_left_lookup_of_five_keys",
    on_short_star(
        "SELECT segment_key, geography_key, discount_key, count(*) AS n, count(date_key) AS dated, "
        "CAST(sum(product_key) AS BIGINT) AS product_keys FROM fact GROUP BY 1, 2, 3"
    ),
)
def jn1(spark, folder):
    """Staged lines looked up in every dimension; the calendar ends early, so some miss."""
    star = ctx.short_star(spark, folder)
    fact = sales_fact(ctx.staged(spark, folder), star.dims, star.rows)
    return fact.groupBy("segment_key", "geography_key", "discount_key").agg(
        F.count("*").alias("n"), F.count("date_key").alias("dated"), F.sum("product_key").alias("product_keys")
    )


@query(
    "jn2_left_join_with_dimension_predicate",
    on_star(
        "SELECT l.product_name, p.product_key, count(*) AS n, "
        "CAST(min(l.manufacturing_price) AS DOUBLE) AS lowest_price "
        "FROM lines l LEFT JOIN dim_product p ON l.product_name = p.product_name AND p.is_current GROUP BY 1, 2"
    ),
)
def jn2(spark, folder):
    """The predicate filters the dimension before the join, so no line is lost."""
    star = ctx.star(spark, folder)
    current = star.dims["dim_product"].where("is_current")
    on = {"product_name": "product_name"}
    joined = lookup(ctx.staged(spark, folder), current, on, "product_key", star.size("dim_product"))
    return joined.groupBy("product_name", "product_key").agg(
        F.count("*").alias("n"), F.min("manufacturing_price").alias("lowest_price")
    )


@query(
    "jn3_star_join_one_dimension",
    on_star(
        "SELECT p.product_name, CAST(sum(f.net_sales) AS DOUBLE) AS net_sales FROM clean f "
        "JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1"
    ),
)
def jn3(spark, folder):
    return rollup(ctx.star(spark, folder), ["dim_product"], ["product_name"], ["net_sales"], None)


@query(
    "jn4_star_join_three_dimensions",
    on_star(
        "SELECT b.discount_band, s.segment_name, g.region, CAST(sum(f.profit) AS DOUBLE) AS total_profit, "
        "count(DISTINCT f.transaction_id) AS transaction_count FROM clean f "
        "JOIN dim_discount b ON f.discount_key = b.discount_key "
        "JOIN dim_segment s ON f.segment_key = s.segment_key "
        "JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY 1, 2, 3"
    ),
)
def jn4(spark, folder):
    via = ["dim_discount", "dim_segment", "dim_geography"]
    by = ["discount_band", "segment_name", "region"]
    return rollup(ctx.star(spark, folder), via, by, ["total_profit"])


FIVE = """SELECT d.year, d.quarter, p.product_name, s.segment_name, g.region, b.discount_band,
  CAST(sum(f.net_sales) AS DOUBLE) AS net_sales, CAST(sum(f.units_sold) AS DOUBLE) AS units_sold
FROM clean f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_product p ON f.product_key = p.product_key
JOIN dim_segment s ON f.segment_key = s.segment_key JOIN dim_geography g ON f.geography_key = g.geography_key
JOIN dim_discount b ON f.discount_key = b.discount_key
WHERE d.year BETWEEN 1996 AND 1997 AND g.region = 'EUROPE' GROUP BY 1, 2, 3, 4, 5, 6"""


@query("jn5_star_join_five_dimensions", on_star(FIVE))
def jn5(spark, folder):
    return rollup(
        ctx.star(spark, folder),
        ["dim_date", "dim_product", "dim_segment", "dim_geography", "dim_discount"],
        ["year", "quarter", "product_name", "segment_name", "region", "discount_band"],
        ["net_sales", "units_sold"],
        None,
        where={"dim_date": F.col("year").between(1996, 1997), "dim_geography": F.col("region") == "EUROPE"},
    )


@query(
    "jn6_ratio_to_total",
    on_star(
        f""", q AS (SELECT s.segment_name, d.year, sum(f.net_sales) AS net_sales FROM clean f
  JOIN dim_segment s ON f.segment_key = s.segment_key JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2),
y AS (SELECT year, sum(net_sales) AS sales FROM q GROUP BY 1)
SELECT q.segment_name, q.year, {pct('q.net_sales', 'y.sales')} AS share_pct FROM q JOIN y ON q.year = y.year"""
    ),
)
def jn6(spark, folder):
    """Detail joined to its own total per year."""
    star = ctx.star(spark, folder)
    detail = rollup(star, ["dim_segment", "dim_date"], ["segment_name", "year"], ["net_sales"], None)
    total = detail.groupBy("year").agg(F.sum("net_sales").alias("sales"))
    return detail.join(total, "year").select(
        "segment_name", "year", percent(F.col("net_sales"), F.col("sales")).alias("share_pct")
    )


GEO = """, q AS (SELECT g.country_name, g.region, d.year, sum(f.net_sales) AS net_sales FROM clean f
  JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1, 2, 3)"""


def _geo(spark, folder):
    by = ["country_name", "region", "year"]
    return rollup(ctx.star(spark, folder), ["dim_geography", "dim_date"], by, ["net_sales"], None)


@query(
    "jn7_ratio_to_composite_total",
    on_star(
        f"""{GEO}, t AS (SELECT region, year, sum(net_sales) AS sales FROM q GROUP BY 1, 2)
SELECT q.country_name, q.region, q.year, {pct('q.net_sales', 't.sales')} AS share_pct
FROM q JOIN t ON q.region = t.region AND q.year = t.year"""
    ),
)
def jn7(spark, folder):
    detail = _geo(spark, folder)
    total = detail.groupBy("region", "year").agg(F.sum("net_sales").alias("sales"))
    return detail.join(total, ["region", "year"]).select(
        "country_name", "region", "year", percent(F.col("net_sales"), F.col("sales")).alias("share_pct")
    )


@query(
    "jn8_self_join_on_shifted_year",
    on_star(
        f"""{GEO}, p AS (SELECT country_name, year + 1 AS next_year, net_sales AS prev FROM q)
SELECT q.country_name, q.year, CAST(p.prev AS DOUBLE) AS prev_year_sales,
  {growth('q.net_sales', 'p.prev')} AS growth_pct
FROM q LEFT JOIN p ON q.country_name = p.country_name AND q.year = p.next_year"""
    ),
)
def jn8(spark, folder):
    detail = _geo(spark, folder)
    before = detail.select(
        "country_name", (F.col("year") + 1).alias("year"), F.col("net_sales").alias("prev_year_sales")
    )
    grown = growth_percent(F.col("net_sales"), F.col("prev_year_sales")).alias("growth_pct")
    return detail.join(before, ["country_name", "year"], "left").select(
        "country_name", "year", "prev_year_sales", grown
    )


TOTALS = on_short_star(
    "SELECT CAST(f.sales AS DOUBLE) AS fact_sales, CAST(c.sales AS DOUBLE) AS clean_sales, "
    "CAST(abs(f.sales - c.sales) AS DOUBLE) AS difference "
    "FROM (SELECT sum(net_sales) AS sales FROM fact) f CROSS JOIN (SELECT sum(net_sales) AS sales FROM clean) c"
)


@query("jn9_cross_join_of_totals", TOTALS)
def jn9(spark, folder):
    """Two one-row totals side by side."""
    fact = ctx.short_star(spark, folder).fact
    whole = fact.agg(F.sum("net_sales").alias("fact_sales"))
    clean = fact.where(~F.col("has_missing_keys")).agg(F.sum("net_sales").alias("clean_sales"))
    return whole.crossJoin(clean).withColumn(
        "difference", F.abs(F.col("fact_sales") - F.col("clean_sales"))
    )


@query("jn10_comma_join_of_totals", TOTALS)
def jn10(spark, folder):
    """The same as SQL with a comma between the totals."""
    ctx.short_star(spark, folder).fact.createOrReplaceTempView("short_fact")
    return spark.sql(
        "WITH f AS (SELECT sum(net_sales) AS fact_sales FROM short_fact), "
        "c AS (SELECT sum(net_sales) AS clean_sales FROM short_fact WHERE NOT has_missing_keys) "
        "SELECT fact_sales, clean_sales, abs(fact_sales - clean_sales) AS difference FROM f, c"
    )


@query(
    "jn11_anti_join_orphans",
    on_short_star(
        "SELECT 'date_key' AS column_name, count(*) AS orphans FROM fact f "
        "LEFT JOIN dim_date d ON f.date_key = d.date_key WHERE d.date_key IS NULL "
        "UNION ALL SELECT 'product_key', count(*) FROM fact f LEFT JOIN dim_product d "
        "ON f.product_key = d.product_key AND d.is_current WHERE d.product_key IS NULL "
        "UNION ALL SELECT 'segment_key', count(*) FROM fact f LEFT JOIN dim_segment d "
        "ON f.segment_key = d.segment_key AND d.segment_name <> 'BUILDING' WHERE d.segment_key IS NULL "
        "UNION ALL SELECT 'geography_key', count(*) FROM fact f LEFT JOIN dim_geography d "
        "ON f.geography_key = d.geography_key AND d.country_name <> 'FRANCE' WHERE d.geography_key IS NULL "
        "UNION ALL SELECT 'discount_key', count(*) FROM fact f LEFT JOIN dim_discount d "
        "ON f.discount_key = d.discount_key AND d.discount_band <> 'Low' WHERE d.discount_key IS NULL"
    ),
)
def jn11(spark, folder):
    """Fact rows without a dimension row; a segment, a country and a band are taken out of their dimensions."""
    star = ctx.short_star(spark, folder)
    sides = {
        "date_key": star.dims["dim_date"],
        "product_key": star.dims["dim_product"].where("is_current"),
        "segment_key": star.dims["dim_segment"].where("segment_name <> 'BUILDING'"),
        "geography_key": star.dims["dim_geography"].where("country_name <> 'FRANCE'"),
        "discount_key": star.dims["dim_discount"].where("discount_band <> 'Low'"),
    }

    def count(key, dim):
        left = star.fact.select(key).join(
            bounded_broadcast(dim.select(key), star.size(f"dim_{key[:-4]}")), key, "left_anti"
        )
        return left.agg(F.lit(key).alias("column_name"), F.count("*").alias("orphans"))

    return reduce(DataFrame.unionByName, [count(k, d) for k, d in sides.items()])


@query(
    "jn12_left_join_conditional_sum",
    on_short_star(
        "SELECT count(*) AS fact_count, sum(CASE WHEN d.date_key IS NULL THEN 1 ELSE 0 END)::BIGINT AS orphans "
        "FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key"
    ),
)
def jn12(spark, folder):
    star = ctx.short_star(spark, folder)
    days = star.dims["dim_date"].select("date_key", F.lit(True).alias("known"))
    joined = star.fact.select("date_key").join(
        bounded_broadcast(days, star.size("dim_date")), "date_key", "left"
    )
    return joined.agg(
        F.count("*").alias("fact_count"),
        F.sum(F.when(F.col("known").isNull(), 1).otherwise(0)).alias("orphans"),
    )


@query(
    "jn13_join_of_two_reports",
    on_star(
        f"""{PRODUCTS}{DISCOUNTS}
SELECT p.product_name, p.profit_category, d.discount_band, d.segment_name, d.discount_effectiveness
FROM profitability p JOIN discounting d ON p.product_name = d.product_name"""
    ),
)
def jn13(spark, folder):
    """Product and discount reports by product name, many rows on the right per name."""
    products = ctx.stored_report(spark, folder, "product_profitability")
    discounts = ctx.stored_report(spark, folder, "discount_analysis")
    return products.select("product_name", "profit_category").join(
        discounts.select("product_name", "discount_band", "segment_name", "discount_effectiveness"),
        "product_name",
    )


UNKNOWN = on_lines(
    """, places AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'ASIA')
SELECT coalesce(r_name, 'Unknown') AS region, coalesce(n_name, 'Unknown') AS country,
  CAST(sum(net_sales) AS DOUBLE) AS total_sales, count(*) AS n
FROM lines LEFT JOIN places ON country_name = n_name GROUP BY 1, 2"""
)


@query("jn14_left_join_unknown_group", UNKNOWN)
def jn14(spark, folder):
    """Flat lines against a lookup without Asia; the rest falls into one unknown group."""
    known = country_regions(spark, folder).where("region <> 'ASIA'")
    sums = ctx.staged(spark, folder).groupBy("country_name").agg(
        F.sum("net_sales").alias("total_sales"), F.count("*").alias("n")
    )
    placed = sums.join(known.withColumn("country", F.col("country_name")), "country_name", "left")
    return placed.groupBy(
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        F.coalesce("country", F.lit("Unknown")).alias("country"),
    ).agg(F.sum("total_sales").alias("total_sales"), F.sum("n").alias("n"))


@query(
    "jn15_flat_date_lookup",
    on_star(
        "SELECT d.year, d.month_name, d.month_number, CAST(sum(l.net_sales) AS DOUBLE) AS total_sales, "
        "CAST(sum(l.profit) AS DOUBLE) AS total_profit FROM lines l "
        "JOIN dim_date d ON l.transaction_date = d.date_day GROUP BY 1, 2, 3"
    ),
)
def jn15(spark, folder):
    return adhoc.monthly_sales_flat(ctx.staged(spark, folder), ctx.star(spark, folder).dims["dim_date"])

"""Registered queries: benchmark star queries and business questions."""

from __future__ import annotations

from salesloom.functions.text import hashed_key
from salesloom.operators.facts import NATURAL_KEY
from salesloom.plans import adhoc
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import growth, hashed, on_lines, on_star, pct, quotient
from salesloom.registry.star import DISCOUNTS, PRODUCTS
from salesloom.sources.retail import country_regions

SALES = "CAST(sum(f.net_sales) AS DOUBLE) AS total_sales, CAST(sum(f.profit) AS DOUBLE) AS total_profit"


@query(
    "bq1_fact_totals",
    on_star(
        f"SELECT count(*) AS row_count, {SALES}, {quotient('sum(f.profit)', 'count(f.profit)')} AS avg_profit "
        "FROM fact f"
    ),
)
def bq1(spark, folder):
    return adhoc.fact_totals(ctx.star(spark, folder))


@query(
    "bq2_sales_by_month_name",
    on_star(
        f"SELECT d.year, d.month_name, count(*) AS transaction_count, {SALES} FROM fact f "
        "JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2"
    ),
)
def bq2(spark, folder):
    return adhoc.sales_by_month_name(ctx.star(spark, folder))


@query(
    "bq2_sales_by_month_name_uncounted",
    on_star(
        f"SELECT d.year, d.month_name, {SALES} FROM fact f "
        "JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2"
    ),
)
def bq2_uncounted(spark, folder):
    return adhoc.sales_by_month_name(ctx.star(spark, folder), with_count=False)


@query(
    "bq3_sales_by_segment_product",
    on_star(
        f"SELECT d.year, s.segment_name, p.product_name, {SALES} FROM clean f "
        "JOIN dim_date d ON f.date_key = d.date_key JOIN dim_segment s ON f.segment_key = s.segment_key "
        "JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1, 2, 3 "
        "ORDER BY 1, sum(f.profit) DESC NULLS FIRST, 2, 3 LIMIT 20"
    ),
)
def bq3(spark, folder):
    return adhoc.sales_by_segment_product(ctx.star(spark, folder))


@query(
    "bq4_country_sales_in_year",
    on_star(
        f"SELECT g.region, g.country_name, {SALES}, count(DISTINCT f.transaction_id) AS transaction_count "
        "FROM clean f JOIN dim_geography g ON f.geography_key = g.geography_key "
        "JOIN dim_date d ON f.date_key = d.date_key WHERE d.year = 1997 GROUP BY 1, 2 "
        "ORDER BY sum(f.profit) DESC NULLS FIRST, 2 LIMIT 10"
    ),
)
def bq4(spark, folder):
    return adhoc.country_sales_in_year(ctx.star(spark, folder), 1997)


@query(
    "bq5_region_drill_down",
    on_star(
        f"SELECT d.year, d.quarter, p.product_name, s.segment_name, g.region, b.discount_band, {SALES}, "
        f"{quotient('sum(f.profit)', 'sum(f.net_sales)')} * 100 AS profit_margin, "
        "CAST(sum(f.units_sold) AS DOUBLE) AS total_units FROM clean f "
        "JOIN dim_date d ON f.date_key = d.date_key JOIN dim_product p ON f.product_key = p.product_key "
        "JOIN dim_segment s ON f.segment_key = s.segment_key "
        "JOIN dim_geography g ON f.geography_key = g.geography_key "
        "JOIN dim_discount b ON f.discount_key = b.discount_key "
        "WHERE d.year BETWEEN 1996 AND 1997 AND g.region = 'EUROPE' GROUP BY 1, 2, 3, 4, 5, 6 "
        "ORDER BY 1, 2, sum(f.profit) DESC NULLS FIRST, 3, 4, 6 LIMIT 20"
    ),
)
def bq5(spark, folder):
    return adhoc.region_drill_down(ctx.star(spark, folder), 1996, 1997, "EUROPE")


@query(
    "bq6_effective_discounts_of_products",
    on_star(
        f"""{PRODUCTS}{DISCOUNTS}
SELECT p.product_name, CAST(p.total_profit AS DOUBLE) AS total_profit, p.profit_margin_pct, p.profit_category,
  d.discount_band, d.discount_effectiveness
FROM profitability p JOIN discounting d ON p.product_name = d.product_name
WHERE p.profit_category = 'High Margin' AND d.discount_effectiveness = 'Highly Effective'
ORDER BY p.total_profit DESC NULLS FIRST, 1, d.discount_band, d.segment_name LIMIT 10"""
    ),
)
def bq6(spark, folder):
    """Over the two stored reports."""
    return adhoc.effective_discounts_of_products(
        ctx.stored_report(spark, folder, "product_profitability"),
        ctx.stored_report(spark, folder, "discount_analysis"),
    )


@query(
    "bq7_product_segment_profit",
    on_star(
        f"SELECT p.product_name, s.segment_name, {SALES} FROM clean f "
        "JOIN dim_product p ON f.product_key = p.product_key JOIN dim_segment s ON f.segment_key = s.segment_key "
        "GROUP BY 1, 2 ORDER BY sum(f.profit) DESC NULLS FIRST, 1, 2 LIMIT 10"
    ),
)
def bq7(spark, folder):
    return adhoc.product_segment_profit(ctx.star(spark, folder))


@query(
    "bq8_monthly_sales_flat",
    on_star(
        f"SELECT d.year, d.month_name, d.month_number, {SALES} FROM lines f "
        "JOIN dim_date d ON f.transaction_date = d.date_day GROUP BY 1, 2, 3"
    ),
)
def bq8_flat(spark, folder):
    return adhoc.monthly_sales_flat(ctx.staged(spark, folder), ctx.star(spark, folder).dims["dim_date"])


@query(
    "bq8_monthly_sales_star",
    on_star(
        f"SELECT d.year, d.month_name, d.month_number, {SALES} FROM fact f "
        "JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3"
    ),
)
def bq8_star(spark, folder):
    return adhoc.monthly_sales_star(ctx.star(spark, folder))


CATEGORIES = (
    "categories AS (SELECT p_name AS product_name, arg_min(p_type, p_partkey) AS product_category "
    "FROM part GROUP BY 1)"
)
MARGIN = f"{quotient('sum(f.profit)', 'sum(f.net_sales)')} * 100 AS profit_margin"


@query(
    "bq9_category_sales_flat",
    on_lines(
        f", {CATEGORIES}, known AS (SELECT * FROM categories WHERE product_category <> 'ECONOMY') "
        f"SELECT coalesce(c.product_category, 'Unknown') AS category, {SALES}, {MARGIN} FROM lines f "
        "LEFT JOIN known c ON f.product_name = c.product_name GROUP BY 1"
    ),
)
def bq9_flat(spark, folder):
    """One category is missing in the lookup and shows as unknown."""
    known = ctx.categories(spark, folder).where("product_category <> 'ECONOMY'")
    return adhoc.category_sales_flat(ctx.staged(spark, folder), known)


@query(
    "bq9_category_sales_star",
    on_star(
        f", {CATEGORIES} SELECT c.product_category AS category, {SALES}, {MARGIN} FROM fact f "
        "JOIN dim_product p ON f.product_key = p.product_key "
        "JOIN categories c ON p.product_name = c.product_name WHERE p.is_current GROUP BY 1"
    ),
)
def bq9_star(spark, folder):
    return adhoc.category_sales_star(ctx.star(spark, folder), ctx.categories(spark, folder))


@query(
    "bq10_country_sales_flat",
    on_lines(
        f""", ids AS (SELECT *, {hashed('transaction_date', 'product_name', 'segment_name', 'country_name',
                                        'discount_band', 'units_sold')} AS transaction_id FROM lines),
places AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA')
SELECT coalesce(r_name, 'Unknown') AS region, coalesce(n_name, 'Unknown') AS country,
  CAST(sum(net_sales) AS DOUBLE) AS total_sales, count(DISTINCT transaction_id) AS transaction_count
FROM ids LEFT JOIN places ON country_name = n_name GROUP BY r_name, n_name"""
    ),
)
def bq10_flat(spark, folder):
    lines = ctx.staged(spark, folder).withColumn("transaction_id", hashed_key(NATURAL_KEY))
    known = country_regions(spark, folder).where("region <> 'AFRICA'")
    return adhoc.country_sales_flat(lines, known)


@query(
    "bq10_country_sales_star",
    on_star(
        "SELECT g.region, g.country_name AS country, CAST(sum(f.net_sales) AS DOUBLE) AS total_sales, "
        "count(DISTINCT f.transaction_id) AS transaction_count FROM fact f "
        "JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY 1, 2"
    ),
)
def bq10_star(spark, folder):
    return adhoc.country_sales_star(ctx.star(spark, folder))


@query(
    "ask1_growth_by_category",
    on_star(
        f""", {CATEGORIES}, m AS (
  SELECT coalesce(c.product_category, 'Unknown') AS category, d.year, d.month_number, sum(f.net_sales) AS net_sales
  FROM clean f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_key = d.date_key
  LEFT JOIN categories c ON p.product_name = c.product_name GROUP BY 1, 2, 3),
l AS (SELECT *, lag(net_sales) OVER (PARTITION BY category ORDER BY year, month_number) AS prev FROM m)
SELECT category, year, month_number, CAST(net_sales AS DOUBLE) AS net_sales,
  CAST(prev AS DOUBLE) AS prev_month_net_sales, {growth('net_sales', 'prev')} AS mom_growth_pct FROM l"""
    ),
)
def ask1(spark, folder):
    """Month-over-month sales growth by product category."""
    return adhoc.category_growth(ctx.star(spark, folder), ctx.categories(spark, folder))


@query(
    "ask2_declining_regions",
    on_star(
        """, r AS (SELECT g.region, d.year, d.quarter, sum(f.profit) AS total_profit FROM clean f
  JOIN dim_geography g ON f.geography_key = g.geography_key JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1, 2, 3),
l AS (SELECT *, lag(total_profit) OVER (PARTITION BY region ORDER BY year, quarter) AS prev_profit FROM r)
SELECT region, year, quarter, CAST(total_profit AS DOUBLE) AS total_profit, CAST(prev_profit AS DOUBLE) AS prev_profit,
  CAST(total_profit - prev_profit AS DOUBLE) AS profit_change FROM l WHERE total_profit < prev_profit"""
    ),
)
def ask2(spark, folder):
    """Regions with falling profit."""
    return adhoc.declining_regions(ctx.star(spark, folder))


@query(
    "ask3_discounts_by_segment",
    on_star(
        f"""SELECT s.segment_name, b.discount_band, CAST(sum(f.gross_sales) AS DOUBLE) AS gross_sales,
  CAST(sum(f.discounts) AS DOUBLE) AS total_discounts, CAST(sum(f.net_sales) AS DOUBLE) AS net_sales,
  CAST(sum(f.profit) AS DOUBLE) AS total_profit, {pct('sum(f.discounts)', 'sum(f.gross_sales)')} AS discount_pct,
  {pct('sum(f.profit)', 'sum(f.net_sales)')} AS profit_margin_pct,
  {pct('sum(f.profit)', 'sum(f.discounts)')} AS profit_per_discount_pct
FROM clean f JOIN dim_segment s ON f.segment_key = s.segment_key
JOIN dim_discount b ON f.discount_key = b.discount_key GROUP BY 1, 2"""
    ),
)
def ask3(spark, folder):
    """How discounts work in each segment."""
    return adhoc.discount_effect_by_segment(ctx.star(spark, folder))


@query(
    "ask4_top_product_margins",
    on_star(
        f""", best AS (SELECT p.product_name FROM clean f JOIN dim_product p ON f.product_key = p.product_key
  GROUP BY 1 ORDER BY sum(f.profit) DESC NULLS FIRST, 1 LIMIT 10)
SELECT p.product_name, d.year, d.month_number, CAST(sum(f.net_sales) AS DOUBLE) AS net_sales,
  CAST(sum(f.profit) AS DOUBLE) AS total_profit, {pct('sum(f.profit)', 'sum(f.net_sales)')} AS profit_margin_pct
FROM clean f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_key = d.date_key
WHERE p.product_name IN (SELECT product_name FROM best) GROUP BY 1, 2, 3"""
    ),
)
def ask4(spark, folder):
    """Margin trend of the ten most profitable products."""
    return adhoc.top_product_margins(ctx.star(spark, folder))

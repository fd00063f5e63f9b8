"""Registered queries: dimensions, fact, incremental load, reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from salesloom.operators import dimensions as dm
from salesloom.operators import incremental as inc
from salesloom.operators.facts import deduplicate, sales_fact
from salesloom.plans import reports as rp
from salesloom.plans.warehouse import Settings, build_star, run_warehouse
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import (
    MONEY,
    SUM_NAMES,
    doubles,
    effect_class,
    growth,
    margin_class,
    on_lines,
    on_short_star,
    on_star,
    pct,
    ratio,
    sums,
)
from salesloom.session import scratch_path
from salesloom.sources import retail
from salesloom.sources.tables import read_table, save_by_year

DATE_COLUMNS = (
    "date_key, date_day, day_of_week, day_name, day_of_month, day_of_year, week_of_year, month_number, "
    "month_name, quarter, year, is_weekend, is_holiday, is_first_day_of_month, is_last_day_of_month"
)
FACT_MONEY = doubles("units_sold", "sale_price", "gross_sales", "discounts", "net_sales", "cogs", "profit")
FACT_COLUMNS = (
    "transaction_id, date_key, product_key, segment_key, geography_key, discount_key, "
    f"{FACT_MONEY}, transaction_date, record_source, has_missing_keys"
)


@query(
    "dm1_dim_date",
    on_star(
        f"SELECT {DATE_COLUMNS} FROM dim_date "
        "WHERE date_day BETWEEN (SELECT min(transaction_date) FROM lines) "
        "AND (SELECT max(transaction_date) FROM lines)"
    ),
)
def dm1(spark, folder):
    """The calendar from the first to the last sale."""
    span = ctx.staged(spark, folder).agg(F.min("transaction_date"), F.max("transaction_date"))
    first, last = span.first()
    return dm.dim_date(spark, first.isoformat(), date.fromordinal(last.toordinal() + 1).isoformat())


@query("dm2_dim_segment", on_star("SELECT segment_key, segment_name, segment_description FROM dim_segment"))
def dm2(spark, folder):
    return dm.dim_segment(ctx.staged(spark, folder))


@query(
    "dm3_dim_product",
    on_star(
        "SELECT product_key, product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, "
        "effective_date, end_date, is_current FROM dim_product"
    ),
)
def dm3(spark, folder):
    return dm.dim_product(ctx.staged(spark, folder))


@query("dm4_dim_geography", on_star("SELECT geography_key, country_name, region, sub_region FROM dim_geography"))
def dm4(spark, folder):
    return dm.dim_geography(ctx.staged(spark, folder), retail.country_regions(spark, folder))


@query(
    "dm5_dim_discount",
    on_star(
        "SELECT discount_key, discount_band, discount_range_min, discount_range_max, discount_description "
        "FROM dim_discount"
    ),
)
def dm5(spark, folder):
    return dm.dim_discount(ctx.staged(spark, folder))


@query(
    "dm6_dense_keys",
    on_lines(
        "SELECT segment_name, country_name, product_name, row_number() OVER "
        "(ORDER BY segment_name, country_name, product_name) AS member_key "
        "FROM (SELECT DISTINCT segment_name, country_name, product_name FROM lines)"
    ),
)
def dm6(spark, folder):
    """Dense keys by the range-partitioned route, as for a dimension too big for one task."""
    names = ["segment_name", "country_name", "product_name"]
    members = ctx.staged(spark, folder).select(*names).distinct()
    return dm.keyed_members(members, names, "member_key", single_task_rows=0)


@query("fc1_fact", on_star(f"SELECT {FACT_COLUMNS} FROM fact"))
def fc1(spark, folder):
    star = ctx.star(spark, folder)
    return sales_fact(ctx.staged(spark, folder), star.dims, star.rows)


def arriving_daily(spark, folder):
    """The staged lines as if each had been landed at the end of its sales day."""
    stamp = F.col("transaction_date").cast("timestamp")
    return ctx.staged(spark, folder).withColumn("load_datetime", stamp)


@query(
    "inc1_incremental_start",
    on_lines("SELECT CAST(max(transaction_date) AS VARCHAR) AS incremental_start, count(*) AS n FROM lines"),
)
def inc1(spark, folder):
    star = ctx.star(spark, folder)
    fact = sales_fact(arriving_daily(spark, folder), star.dims, star.rows)
    start = inc.incremental_start(fact)
    return fact.agg(F.lit(start).alias("incremental_start"), F.count("*").alias("n"))


@query(
    "inc2_incremental_rows",
    on_lines(
        "SELECT transaction_date, count(*) AS n, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM lines "
        "WHERE transaction_date > DATE '1999-12-31' GROUP BY 1"
    ),
)
def inc2(spark, folder):
    new = inc.loaded_after(arriving_daily(spark, folder), "1999-12-31")
    return new.groupBy("transaction_date").agg(
        F.count("*").alias("n"), F.sum("net_sales").alias("net_sales")
    )


UPSERT_SQL = on_star(
    """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY net_sales DESC, gross_sales DESC, cogs DESC, profit DESC, sale_price DESC) AS r FROM fact),
once AS (SELECT * FROM ranked WHERE r = 1),
revised AS (
  SELECT * REPLACE (CASE WHEN transaction_date >= DATE '1999-01-01'
    THEN CAST(net_sales * 2 AS DECIMAL(18,2)) ELSE net_sales END AS net_sales) FROM once)
SELECT transaction_id, date_key, product_key, CAST(units_sold AS DOUBLE) AS units_sold,
  CAST(net_sales AS DOUBLE) AS net_sales, CAST(year(transaction_date) AS INTEGER) AS sale_year
FROM revised"""
)


@query("inc3_upsert", UPSERT_SQL)
def inc3(spark, folder):
    """Days up to 1999 loaded first; then 1999 onwards arrives, partly known, with revised sales."""
    star = ctx.star(spark, folder)
    fact = star.fact.drop("sale_year")
    path = scratch_path(spark, "merged-fact")
    later = F.coalesce(F.col("transaction_date") >= F.lit("2000-01-01").cast("date"), F.lit(False))
    save_by_year(deduplicate(fact.where(~later), "latest"), path)
    revised = fact.where(F.col("transaction_date") >= F.lit("1999-01-01").cast("date")).withColumn(
        "net_sales", (F.col("net_sales") * 2).cast("decimal(18,2)")
    )
    out = inc.upsert(spark, path, revised, policy="latest")
    return out.select("transaction_id", "date_key", "product_key", "units_sold", "net_sales", "sale_year")


@query(
    "inc4_schema_sync",
    on_star(
        "SELECT segment_key, count(*) AS n, count(CAST(NULL AS VARCHAR)) AS with_channel, "
        "CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM fact GROUP BY 1"
    ),
)
def inc4(spark, folder):
    """The fact follows a layout that gains a column and loses one."""
    from pyspark.sql import types as T

    fact = ctx.star(spark, folder).fact
    fields = [f for f in fact.schema.fields if f.name != "record_source"]
    layout = T.StructType([*fields, T.StructField("channel", T.StringType())])
    synced = inc.sync_columns(fact, layout)
    return synced.groupBy("segment_key").agg(
        F.count("*").alias("n"),
        F.count("channel").alias("with_channel"),
        F.sum("net_sales").alias("net_sales"),
    )


@query("inc5_full_refresh", on_star(f"SELECT {FACT_COLUMNS} FROM fact"))
def inc5(spark, folder):
    """A second full build over a stored warehouse replaces it."""
    path = scratch_path(spark, "refreshed")
    settings = ctx.settings(spark, folder)
    lines = ctx.staged(spark, folder)
    build_star(lines.where(F.col("year") < 1998), path, settings)
    return build_star(lines, path, settings).fact.drop("sale_year")


@query(
    "pip1_warehouse_run",
    on_star(
        f""", months AS (SELECT d.year, d.month_number, {sums('f.')} FROM clean f
  JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2)
SELECT year, month_number, CAST(gross_sales AS DOUBLE) AS gross_sales,
  CAST(net_sales AS DOUBLE) AS net_sales, CAST(total_profit AS DOUBLE) AS total_profit,
  true AS every_step_done
FROM months"""
    ),
)
def pip1(spark, folder):
    """From the raw text file to the reports in one call."""
    root = scratch_path(spark, "run")
    settings = Settings(*ctx.SPINE, regions=retail.country_regions(spark, folder), policy="keep_all")
    summary = run_warehouse(spark, root, ctx.raw_csv(spark, folder), full_refresh=True, settings=settings)
    done = {"load", "dimensions and fact", "reports", "checks"} <= set(summary.steps)
    months = read_table(spark, f"{root}/analytics/monthly_sales_analysis")
    return months.select(
        "year", "month_number", "gross_sales", "net_sales", "total_profit",
        F.lit(done).alias("every_step_done"),
    )


@query(
    "stream1_incremental_merge",
    on_star(
        """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY net_sales DESC, gross_sales DESC, cogs DESC, profit DESC, sale_price DESC) AS r FROM fact)
SELECT date_key, segment_key, count(*) AS n, CAST(sum(net_sales) AS DOUBLE) AS net_sales,
  CAST(sum(profit) AS DOUBLE) AS profit FROM ranked WHERE r = 1 GROUP BY 1, 2"""
    ),
)
def stream1(spark, folder):
    """The raw files as a stream, merged into a new fact."""
    from salesloom.streaming.incremental_stream import merge_files

    star = ctx.star(spark, folder)
    path = scratch_path(spark, "streamed-fact")
    merge_files(
        spark, ctx.raw_csv(spark, folder), path, star.dims, scratch_path(spark, "stream"), "latest",
        ctx.loaded_at(),
    ).awaitTermination()
    return (
        spark.read.parquet(path)
        .groupBy("date_key", "segment_key")
        .agg(F.count("*").alias("n"), F.sum("net_sales").alias("net_sales"), F.sum("profit").alias("profit"))
    )


# --- reports ---------------------------------------------------------------

MONTHS = f""", monthly AS (
  SELECT d.year, d.month_number, d.month_name, {sums('f.')}
  FROM clean f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3),
previous AS (
  SELECT *, lag(net_sales) OVER w AS prev_month_net_sales, lag(total_profit) OVER w AS prev_month_profit,
    lag(units_sold) OVER w AS prev_month_units
  FROM monthly WINDOW w AS (ORDER BY year, month_number))"""


def _change(current: str, previous: str) -> str:
    return f"CAST({current} - coalesce({previous}, 0) AS DOUBLE)"


@query(
    "rp1_monthly_sales_analysis",
    on_star(
        f"""{MONTHS}
SELECT year, month_number, month_name, {MONEY}, transaction_count,
  {doubles('prev_month_net_sales', 'prev_month_profit', 'prev_month_units')},
  {_change('net_sales', 'prev_month_net_sales')} AS net_sales_mom_change,
  {growth('net_sales', 'prev_month_net_sales')} AS net_sales_mom_pct_change,
  {_change('total_profit', 'prev_month_profit')} AS profit_mom_change,
  {growth('total_profit', 'prev_month_profit')} AS profit_mom_pct_change,
  {_change('units_sold', 'prev_month_units')} AS units_mom_change,
  {growth('units_sold', 'prev_month_units')} AS units_mom_pct_change
FROM previous"""
    ),
)
def rp1(spark, folder):
    return rp.monthly_sales_analysis(ctx.star(spark, folder))


PRODUCTS = f""", products AS (
  SELECT p.product_key, p.product_name, p.manufacturing_price, {sums('f.')}
  FROM clean f JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1, 2, 3),
profitability AS (
  SELECT *, {ratio('total_profit', 'units_sold')} AS profit_per_unit,
    {pct('total_profit', 'net_sales')} AS profit_margin_pct,
    {ratio('net_sales', 'units_sold')} AS avg_sale_price,
    {pct('total_discounts', 'gross_sales')} AS discount_pct,
    row_number() OVER (ORDER BY total_profit DESC NULLS FIRST, product_key) AS profit_rank,
    row_number() OVER (ORDER BY units_sold DESC NULLS FIRST, product_key) AS volume_rank,
    row_number() OVER (ORDER BY net_sales DESC NULLS FIRST, product_key) AS revenue_rank,
    {margin_class('total_profit', 'net_sales')} AS profit_category
  FROM products)"""


@query(
    "rp2_product_profitability",
    on_star(
        f"""{PRODUCTS}
SELECT product_key, product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, {MONEY},
  transaction_count, profit_per_unit, profit_margin_pct, avg_sale_price, discount_pct, profit_rank,
  volume_rank, revenue_rank, profit_category FROM profitability"""
    ),
)
def rp2(spark, folder):
    return rp.product_profitability(ctx.star(spark, folder))


@query(
    "rp3_segment_performance",
    on_star(
        f""", quarters AS (
  SELECT s.segment_key, s.segment_name, d.year, d.quarter, {sums('f.')}
  FROM clean f JOIN dim_segment s ON f.segment_key = s.segment_key
  JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3, 4),
yearly AS (SELECT year, sum(net_sales) AS sales, sum(total_profit) AS profit FROM quarters GROUP BY 1),
grown AS (SELECT *, lag(net_sales) OVER (PARTITION BY segment_key, year ORDER BY quarter) AS prev_quarter_sales
  FROM quarters)
SELECT q.segment_key, q.segment_name, q.year, q.quarter, {doubles(*SUM_NAMES, prefix='q.')},
  q.transaction_count, {pct('q.total_profit', 'q.net_sales')} AS profit_margin_pct,
  {pct('q.total_discounts', 'q.gross_sales')} AS discount_pct,
  {pct('q.net_sales', 'y.sales')} AS sales_contribution_pct,
  {pct('q.total_profit', 'y.profit')} AS profit_contribution_pct,
  CAST(q.prev_quarter_sales AS DOUBLE) AS prev_quarter_sales,
  {growth('q.net_sales', 'q.prev_quarter_sales')} AS sales_qoq_growth_pct
FROM grown q JOIN yearly y ON q.year = y.year"""
    ),
)
def rp3(spark, folder):
    return rp.segment_performance(ctx.star(spark, folder))


@query(
    "rp4_geography_performance",
    on_star(
        f""", geo AS (
  SELECT g.geography_key, g.country_name, g.region, d.year, {sums('f.')}
  FROM clean f JOIN dim_geography g ON f.geography_key = g.geography_key
  JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2, 3, 4),
regional AS (SELECT region, year, sum(net_sales) AS sales, sum(total_profit) AS profit FROM geo GROUP BY 1, 2),
before AS (SELECT geography_key, year + 1 AS next_year, net_sales AS prev_year_sales,
  total_profit AS prev_year_profit FROM geo)
SELECT m.geography_key, m.country_name, m.region, m.year, {doubles(*SUM_NAMES, prefix='m.')},
  m.transaction_count, {pct('m.total_profit', 'm.net_sales')} AS profit_margin_pct,
  {pct('m.total_discounts', 'm.gross_sales')} AS discount_pct,
  {pct('m.net_sales', 'r.sales')} AS region_sales_contribution_pct,
  {pct('m.total_profit', 'r.profit')} AS region_profit_contribution_pct,
  CAST(b.prev_year_sales AS DOUBLE) AS prev_year_sales, CAST(b.prev_year_profit AS DOUBLE) AS prev_year_profit,
  {growth('m.net_sales', 'b.prev_year_sales')} AS sales_yoy_growth_pct,
  {growth('m.total_profit', 'b.prev_year_profit')} AS profit_yoy_growth_pct,
  row_number() OVER (PARTITION BY m.year ORDER BY m.total_profit DESC NULLS FIRST, m.geography_key)
    AS overall_profit_rank,
  row_number() OVER (PARTITION BY m.region, m.year ORDER BY m.total_profit DESC NULLS FIRST, m.geography_key)
    AS region_profit_rank
FROM geo m JOIN regional r ON m.region = r.region AND m.year = r.year
LEFT JOIN before b ON m.geography_key = b.geography_key AND m.year = b.next_year"""
    ),
)
def rp4(spark, folder):
    return rp.geography_performance(ctx.star(spark, folder))


DISCOUNTS = f""", cells AS (
  SELECT b.discount_key, b.discount_band, p.product_key, p.product_name, s.segment_key, s.segment_name,
    {sums('f.')}
  FROM clean f JOIN dim_discount b ON f.discount_key = b.discount_key
  JOIN dim_product p ON f.product_key = p.product_key
  JOIN dim_segment s ON f.segment_key = s.segment_key GROUP BY 1, 2, 3, 4, 5, 6),
overall AS (SELECT p.product_key, sum(f.net_sales) AS sales, sum(f.profit) AS profit, sum(f.units_sold) AS units
  FROM clean f JOIN dim_product p ON f.product_key = p.product_key GROUP BY 1),
discounting AS (
  SELECT c.discount_key, c.discount_band, c.product_key, c.product_name, c.segment_key, c.segment_name,
    {doubles(*SUM_NAMES, prefix='c.')}, c.transaction_count,
    {pct('c.total_discounts', 'c.gross_sales')} AS discount_pct,
    {pct('c.total_profit', 'c.net_sales')} AS profit_margin_pct,
    {pct('c.net_sales', 'o.sales')} AS pct_of_product_sales,
    {pct('c.total_profit', 'o.profit')} AS pct_of_product_profit,
    {pct('c.units_sold', 'o.units')} AS pct_of_product_units,
    {ratio('c.total_discounts', 'c.units_sold')} AS discount_per_unit,
    {ratio('c.total_profit', 'c.total_discounts')} AS profit_per_discount_dollar,
    CASE WHEN c.total_profit > 0 AND c.total_discounts > 0
      THEN {ratio('c.total_profit', 'c.total_discounts')} ELSE 0::DOUBLE END AS roi_ratio,
    {effect_class('c.total_profit', 'c.total_discounts')} AS discount_effectiveness
  FROM cells c JOIN overall o ON c.product_key = o.product_key)"""


@query("rp5_discount_analysis", on_star(f"{DISCOUNTS}\nSELECT * FROM discounting"))
def rp5(spark, folder):
    return rp.discount_analysis(ctx.star(spark, folder))


def _top(name: str, by: str, dim: str, key: str) -> str:
    first = by.split(",")[0]
    return f""", {name} AS (
  SELECT {by}, {sums('f.')} FROM clean f JOIN {dim} x ON f.{key} = x.{key} GROUP BY {by}
  ORDER BY total_profit DESC NULLS FIRST, {first} LIMIT 5)"""


def _block(name: str, category: str, period: str, value: str, volume: str = "CAST(units_sold AS DOUBLE)") -> str:
    return f"""
SELECT '{category}' AS metric_category, {period} AS time_period, {value} AS dimension_value,
  CAST(net_sales AS DOUBLE) AS revenue, CAST(total_profit AS DOUBLE) AS profit,
  {pct('total_profit', 'net_sales')} AS margin_pct, {volume} AS volume,
  CAST(NULL AS DOUBLE) AS revenue_pop_pct, CAST(NULL AS DOUBLE) AS profit_pop_pct,
  CAST(NULL AS DOUBLE) AS margin_pop_delta FROM {name}"""


DASHBOARD = f""", company AS (
  SELECT d.year, d.quarter, {sums('f.')} FROM clean f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2),
margins AS (SELECT *, {pct('total_profit', 'net_sales')} AS margin_pct FROM company),
lagged AS (SELECT *, lag(net_sales) OVER w AS ps, lag(total_profit) OVER w AS pp, lag(margin_pct) OVER w AS pm
  FROM margins WINDOW w AS (ORDER BY year, quarter))
{_top('best_products', 'x.product_name', 'dim_product', 'product_key')}
{_top('best_segments', 'x.segment_name', 'dim_segment', 'segment_key')}
{_top('best_countries', 'x.country_name, x.region', 'dim_geography', 'geography_key')},
bands AS (SELECT x.discount_band, {sums('f.')} FROM clean f
  JOIN dim_discount x ON f.discount_key = x.discount_key GROUP BY 1)
SELECT 'Overall Performance' AS metric_category, year::VARCHAR || '-Q' || quarter::VARCHAR AS time_period,
  'Company' AS dimension_value, CAST(net_sales AS DOUBLE) AS revenue, CAST(total_profit AS DOUBLE) AS profit,
  margin_pct, CAST(units_sold AS DOUBLE) AS volume, {growth('net_sales', 'ps')} AS revenue_pop_pct,
  {growth('total_profit', 'pp')} AS profit_pop_pct,
  round(CAST(margin_pct - coalesce(pm, 0) AS DECIMAL(38,10)), 2)::DOUBLE AS margin_pop_delta
FROM lagged
UNION ALL {_block('best_products', 'Top Products', "'All Time'", 'product_name')}
UNION ALL {_block('best_segments', 'Top Segments', "'All Time'", 'segment_name')}
UNION ALL {_block('best_countries', 'Top Countries', 'region', 'country_name')}
UNION ALL {_block('bands', 'Discount Effectiveness', effect_class('total_profit', 'total_discounts'),
                  'discount_band', 'CAST(NULL AS DOUBLE)')}"""


@query("rp6_executive_dashboard", on_star(DASHBOARD))
def rp6(spark, folder):
    return rp.executive_dashboard(ctx.star(spark, folder))


@query("rp6_executive_dashboard_with_quarantine", on_short_star(DASHBOARD))
def rp6_short(spark, folder):
    """The dashboard over a fact with quarantined rows."""
    return rp.executive_dashboard(ctx.short_star(spark, folder))

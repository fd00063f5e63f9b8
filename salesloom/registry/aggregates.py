"""Registered queries: aggregations, top lists, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import percent, quotient
from salesloom.functions.text import quarter_label
from salesloom.operators import profiling as pf
from salesloom.operators.dimensions import product_versions
from salesloom.operators.facts import sales_fact
from salesloom.operators.incremental import high_water
from salesloom.operators.quality import dimension_counts, fact_metrics
from salesloom.plans.reports import executive_dashboard
from salesloom.plans.rollup import rollup
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import effect_class, on_lines, on_star, pct
from salesloom.registry.oracle import quotient as sql_quotient
from salesloom.registry.star import arriving_daily
from salesloom.schemas import STAGING


@query(
    "ag1_sums_by_six_keys",
    on_star(
        "SELECT discount_key, product_key, segment_key, geography_key, "
        "CAST(date_key // 10000 AS INTEGER) AS year, has_missing_keys, CAST(sum(net_sales) AS DOUBLE) AS net_sales, "
        "CAST(sum(profit) AS DOUBLE) AS profit FROM fact GROUP BY 1, 2, 3, 4, 5, 6"
    ),
)
def ag1(spark, folder):
    fact = ctx.star(spark, folder).fact
    year = F.floor(F.col("date_key") / 10000).cast("int").alias("year")
    return fact.groupBy(
        "discount_key", "product_key", "segment_key", "geography_key", year, "has_missing_keys"
    ).agg(F.sum("net_sales").alias("net_sales"), F.sum("profit").alias("profit"))


@query(
    "ag2_distinct_count_with_sums",
    on_star(
        "SELECT segment_key, count(*) AS n, count(DISTINCT transaction_id) AS ids, "
        "CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM fact GROUP BY 1"
    ),
)
def ag2(spark, folder):
    """Distinct ids and sums in one grouping: exact, without the stored surplus counts."""
    return ctx.star(spark, folder).fact.groupBy("segment_key").agg(
        F.count("*").alias("n"),
        F.count_distinct("transaction_id").alias("ids"),
        F.sum("net_sales").alias("net_sales"),
    )


@query(
    "ag2_additive_distinct_count",
    on_star(
        "SELECT s.segment_name, count(DISTINCT f.transaction_id) AS transaction_count "
        "FROM clean f JOIN dim_segment s ON f.segment_key = s.segment_key GROUP BY 1"
    ),
)
def ag2_additive(spark, folder):
    """The same count from rows less stored surplus copies: no shuffle of ids."""
    return rollup(ctx.star(spark, folder), ["dim_segment"], ["segment_name"], [])


@query(
    "ag3_first_day_per_price",
    on_star(
        "SELECT product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, effective_date "
        "FROM product_versions"
    ),
)
def ag3(spark, folder):
    return product_versions(ctx.staged(spark, folder))


@query(
    "ag4_global_average",
    on_star(f"SELECT count(*) AS n, {sql_quotient('sum(profit)', 'count(profit)')} AS avg_profit FROM fact"),
)
def ag4(spark, folder):
    return ctx.star(spark, folder).fact.agg(
        F.count("*").alias("n"), quotient(F.sum("profit"), F.count("profit")).alias("avg_profit")
    )


@query("ag5_high_water_mark", on_lines("SELECT max(transaction_date) AS high_water FROM lines"))
def ag5(spark, folder):
    """Latest load day of a fact whose lines were landed on their sales days."""
    star = ctx.star(spark, folder)
    fact = sales_fact(arriving_daily(spark, folder), star.dims, star.rows)
    return high_water(fact).select(F.to_date("high_water").alias("high_water"))


CONDITIONAL = (
    "SELECT count(*) AS row_count, CAST(sum(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    "AS null_key_count, count(*) - count(DISTINCT transaction_id) AS duplicate_key_count, "
    "CAST(sum(CASE WHEN has_missing_keys THEN 1 ELSE 0 END) AS BIGINT) AS records_with_missing_keys, "
    "CAST(sum(CASE WHEN net_sales < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_sales_count, "
    "CAST(sum(CASE WHEN profit < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_profit_count, "
    "CAST(sum(CASE WHEN units_sold <= 0 AND net_sales > 0 THEN 1 ELSE 0 END) AS BIGINT) "
    "AS inconsistent_units_count FROM fact"
)


@query("ag6_conditional_counts", on_star(CONDITIONAL))
def ag6(spark, folder):
    return fact_metrics(ctx.star(spark, folder).fact)


@query(
    "ag7_duplicate_keys",
    on_star(
        " UNION ALL ".join(
            f"SELECT '{t}' AS dimension_table, count(*) AS row_count, "
            f"CAST(sum(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_key_count, "
            f"count(*) - count(DISTINCT {k}) AS duplicate_key_count FROM {t}"
            for t, k in (
                ("dim_date", "date_key"),
                ("dim_product", "product_key"),
                ("dim_segment", "segment_key"),
                ("dim_geography", "geography_key"),
                ("dim_discount", "discount_key"),
            )
        )
    ),
)
def ag7(spark, folder):
    return dimension_counts(ctx.star(spark, folder).dims, strict=True)


@query(
    "ag8_class_over_sums",
    on_star(
        f"SELECT b.discount_band, {pct('sum(f.discounts)', 'sum(f.gross_sales)')} AS discount_pct, "
        f"{effect_class('sum(f.profit)', 'sum(f.discounts)')} AS effectiveness "
        "FROM clean f JOIN dim_discount b ON f.discount_key = b.discount_key GROUP BY 1"
    ),
)
def ag8(spark, folder):
    from salesloom.functions.measures import discount_effectiveness

    totals = ["gross_sales", "total_discounts", "total_profit"]
    bands = rollup(ctx.star(spark, folder), ["dim_discount"], ["discount_band"], totals, None)
    profit, discounts = F.col("total_profit"), F.col("total_discounts")
    return bands.select(
        "discount_band",
        percent(discounts, F.col("gross_sales")).alias("discount_pct"),
        discount_effectiveness(profit, discounts).alias("effectiveness"),
    )


@query(
    "ag9_two_level_sums",
    on_star(
        """, q AS (SELECT s.segment_key, d.year, d.quarter, sum(f.net_sales) AS net_sales FROM clean f
  JOIN dim_segment s ON f.segment_key = s.segment_key JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY 1, 2, 3)
SELECT year, count(*) AS cells, CAST(sum(net_sales) AS DOUBLE) AS total_year_sales FROM q GROUP BY 1"""
    ),
)
def ag9(spark, folder):
    by = ["segment_key", "year", "quarter"]
    cells = rollup(ctx.star(spark, folder), ["dim_segment", "dim_date"], by, ["net_sales"], None)
    return cells.groupBy("year").agg(
        F.count("*").alias("cells"), F.sum("net_sales").alias("total_year_sales")
    )


@query(
    "ag10_distinct_rows",
    on_lines(
        "SELECT DISTINCT product_name, CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, "
        "transaction_date FROM lines WHERE product_name IS NOT NULL"
    ),
)
def ag10(spark, folder):
    lines = ctx.staged(spark, folder).where(F.col("product_name").isNotNull())
    return lines.select("product_name", "manufacturing_price", "transaction_date").distinct()


@query(
    "ag11_value_counts",
    on_lines(
        " UNION ALL ".join(
            f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM lines "
            f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, value LIMIT 5)"
            for c in pf.CATEGORIES
        )
    ),
)
def ag11(spark, folder):
    """The most frequent values of every category."""
    counts = [pf.value_counts(ctx.staged(spark, folder), c) for c in pf.CATEGORIES]
    return reduce(DataFrame.unionByName, counts)


REPRICED = on_lines(
    "SELECT product_name, count(DISTINCT manufacturing_price) AS prices FROM lines "
    "WHERE product_name IS NOT NULL GROUP BY 1 "
    "HAVING count(DISTINCT manufacturing_price) > 1"
)


@query("ag12_groups_with_several_values", REPRICED)
def ag12(spark, folder):
    return pf.repriced_products(ctx.staged(spark, folder))


DISCOUNT_SHARE = on_lines(
    "SELECT discount_band, CAST(sum(discounts) AS DOUBLE) AS discounts, "
    f"CAST(sum(gross_sales) AS DOUBLE) AS gross_sales, {pct('sum(discounts)', 'sum(gross_sales)')} AS discount_pct "
    "FROM lines WHERE discount_band IS NOT NULL GROUP BY 1"
)


@query("ag13_sums_with_percentage", DISCOUNT_SHARE)
def ag13(spark, folder):
    return pf.discount_share(ctx.staged(spark, folder))


_DESCRIBED = (
    "units_sold", "manufacturing_price", "sale_price", "gross_sales", "discounts", "net_sales", "cogs", "profit",
    "month_number", "year",
)


def described(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lines"
        for c in columns
    )


def rounded_description(df):
    return df.withColumns(
        {
            **{c: F.round(c, 4) for c in ("mean", "std")},
            **{c: F.round(c, 6) for c in ("p25", "p50", "p75")},
        }
    )


@query("ag14_descriptive_statistics", on_lines(described(_DESCRIBED)))
def ag14(spark, folder):
    """Count, mean, deviation, extremes and exact quartiles of each column."""
    return rounded_description(pf.describe(ctx.staged(spark, folder), _DESCRIBED))


# What the text file leaves out, and what its load adds.
_MISSING = {
    "discounts": "count(*) FILTER (WHERE discounts = 0)",
    "profit": "count(*) FILTER (WHERE discount_band = 'None')",
    "load_datetime": "count(*) FILTER (WHERE false)",
}


@query(
    "ag15_null_counts",
    on_lines(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {_MISSING.get(c, f'count(*) - count({c})')} AS null_count FROM lines"
            for c in STAGING.names
        )
    ),
)
def ag15(spark, folder):
    """NULLs of every column of the staged text file, in one pass."""
    from salesloom.operators.staging import stage, stamp_load
    from salesloom.schemas import RAW_COLUMNS
    from salesloom.sources.files import read_text_csv

    raw = read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    return pf.null_counts(stage(stamp_load(raw, "raw_financials")))


_WHOLE = [c for c in STAGING.names if c != "load_datetime"]


@query(
    "ag16_duplicate_rows",
    on_lines(
        "SELECT 'whole rows' AS compared, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT count(*) AS n FROM lines GROUP BY {', '.join(_WHOLE)}) UNION ALL "
        "SELECT 'some columns', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lines "
        "GROUP BY segment_name, product_name, discount_band, units_sold, year)"
    ),
)
def ag16(spark, folder):
    """Rows that repeat another one as a whole, and in some of their columns."""
    lines = ctx.staged(spark, folder)
    some = ["segment_name", "product_name", "discount_band", "units_sold", "year"]
    whole = pf.duplicate_rows(lines).withColumn("compared", F.lit("whole rows"))
    return whole.unionByName(pf.duplicate_rows(lines.select(*some)).withColumn("compared", F.lit("some columns")))


COVERAGE = on_lines(
    "SELECT min(transaction_date) AS earliest_date, max(transaction_date) AS latest_date, "
    "count(DISTINCT month_number) AS months, count(DISTINCT year) AS years FROM lines"
)


@query("ag17_date_range", COVERAGE)
def ag17(spark, folder):
    return pf.date_coverage(ctx.staged(spark, folder))


# --- sort, limit, top lists -------------------------------------------------



@query(
    "tk1_mixed_sort",
    on_star(
        """, r AS (SELECT d.year, s.segment_name, sum(f.profit) AS total_profit FROM clean f
  JOIN dim_segment s ON f.segment_key = s.segment_key JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2)
SELECT year, segment_name, CAST(total_profit AS DOUBLE) AS total_profit,
  row_number() OVER (ORDER BY year, total_profit DESC NULLS FIRST, segment_name) AS position FROM r"""
    ),
)
def tk1(spark, folder):
    """Mixed directions; the position after the sort is part of the result."""
    from salesloom.operators.ordering import row_numbers

    totals = rollup(
        ctx.star(spark, folder), ["dim_segment", "dim_date"], ["year", "segment_name"], ["total_profit"], None
    )
    order = [F.col("year"), F.col("total_profit").desc_nulls_first(), F.col("segment_name")]
    return row_numbers(totals.orderBy(*order), order, "position")


def _top_sql(by: str, dim: str, key: str, limit: int) -> str:
    return on_star(
        f"SELECT x.{by}, CAST(sum(f.profit) AS DOUBLE) AS total_profit FROM clean f "
        f"JOIN {dim} x ON f.{key} = x.{key} GROUP BY 1 ORDER BY sum(f.profit) DESC NULLS FIRST, 1 LIMIT {limit}"
    )


def _top(spark, folder, dim, by, limit):
    totals = rollup(ctx.star(spark, folder), [dim], [by], ["total_profit"], None)
    return totals.orderBy(F.col("total_profit").desc_nulls_first(), by).limit(limit)


_BOARDS = {
    "product_name": ("dim_product", "product_key"),
    "segment_name": ("dim_segment", "segment_key"),
    "country_name": ("dim_geography", "geography_key"),
}


@query("tk2_top_five_products", _top_sql("product_name", "dim_product", "product_key", 5))
def tk2(spark, folder):
    return _top(spark, folder, "dim_product", "product_name", 5)


@query(
    "tk2_three_leaderboards",
    on_star(
        " UNION ALL ".join(
            f"SELECT * FROM (SELECT '{by}' AS board, x.{by} AS member, CAST(sum(f.profit) AS DOUBLE) AS total_profit "
            f"FROM clean f JOIN {dim} x ON f.{key} = x.{key} GROUP BY 2 ORDER BY sum(f.profit) DESC NULLS FIRST, 2 LIMIT 5)"
            for by, (dim, key) in _BOARDS.items()
        )
    ),
)
def tk2_boards(spark, folder):
    """The best five products, segments and countries."""
    boards = [
        _top(spark, folder, dim, by, 5).select(F.lit(by).alias("board"), F.col(by).alias("member"), "total_profit")
        for by, (dim, _) in _BOARDS.items()
    ]
    return reduce(DataFrame.unionByName, boards)


@query("tk3_top_ten_countries", _top_sql("country_name", "dim_geography", "geography_key", 10))
def tk3(spark, folder):
    return _top(spark, folder, "dim_geography", "country_name", 10)


@query(
    "tk4_hidden_sort_keys",
    on_star(
        """, q AS (SELECT d.year, d.quarter, sum(f.net_sales) AS revenue FROM clean f
  JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2)
SELECT year::VARCHAR || '-Q' || quarter::VARCHAR AS time_period, CAST(revenue AS DOUBLE) AS revenue FROM q"""
    ),
)
def tk4(spark, folder):
    """Sorted by a period number that is not part of the result."""
    quarters = rollup(ctx.star(spark, folder), ["dim_date"], ["year", "quarter"], ["net_sales"], None)
    keyed = quarters.withColumn("time_sort", F.col("year") * 10 + F.col("quarter"))
    return keyed.orderBy("time_sort").select(
        quarter_label(F.col("year"), F.col("quarter")).alias("time_period"), F.col("net_sales").alias("revenue")
    )


@query(
    "tk5_case_sort",
    on_star(
        """, r AS (SELECT discount_band, count(*) AS n, CASE discount_band WHEN 'None' THEN 1 WHEN 'Low' THEN 2
  WHEN 'Medium' THEN 3 WHEN 'High' THEN 4 ELSE 5 END AS rank FROM lines GROUP BY 1)
SELECT discount_band, n, row_number() OVER (ORDER BY rank, discount_band) AS position FROM r"""
    ),
)
def tk5(spark, folder):
    from salesloom.operators.ordering import row_numbers

    rank = F.lit(5)
    for place, band in ((4, "High"), (3, "Medium"), (2, "Low"), (1, "None")):
        rank = F.when(F.col("discount_band") == band, place).otherwise(rank)
    counts = ctx.staged(spark, folder).groupBy("discount_band").agg(F.count("*").alias("n"))
    return row_numbers(counts, [rank, F.col("discount_band")], "position")


@query(
    "tk6_descending_totals",
    on_lines(
        "SELECT country_name, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM lines "
        "WHERE country_name IS NOT NULL GROUP BY 1 ORDER BY sum(net_sales) DESC, 1 LIMIT 10"
    ),
)
def tk6(spark, folder):
    return pf.ranked_total(ctx.staged(spark, folder), "country_name", "net_sales", 10)


# --- unions -----------------------------------------------------------------


@query(
    "st1_union_of_blocks",
    on_star(
        """SELECT 'Overall Performance' AS metric_category, count(*) AS n FROM
  (SELECT DISTINCT d.year, d.quarter FROM clean f JOIN dim_date d ON f.date_key = d.date_key)
UNION ALL SELECT 'Top Products', least(5, count(DISTINCT p.product_name)) FROM clean f
  JOIN dim_product p ON f.product_key = p.product_key
UNION ALL SELECT 'Top Segments', least(5, count(DISTINCT segment_key)) FROM clean
UNION ALL SELECT 'Top Countries', least(5, count(DISTINCT geography_key)) FROM clean
UNION ALL SELECT 'Discount Effectiveness', count(DISTINCT discount_key) FROM clean"""
    ),
)
def st1(spark, folder):
    """Rows per block of the dashboard union."""
    rows = executive_dashboard(ctx.star(spark, folder))
    return rows.groupBy("metric_category").agg(F.count("*").alias("n"))


@query(
    "st2_metrics_from_one_pass",
    on_star(
        f""", m AS ({CONDITIONAL})
SELECT 'row_count' AS metric_name, row_count AS metric_value FROM m
UNION ALL SELECT 'records_with_missing_keys', records_with_missing_keys FROM m
UNION ALL SELECT 'negative_sales_count', negative_sales_count FROM m
UNION ALL SELECT 'negative_profit_count', negative_profit_count FROM m"""
    ),
)
def st2(spark, folder):
    """Several metrics of one table as rows: a single aggregate, then unpivoted."""
    names = ["row_count", "records_with_missing_keys", "negative_sales_count", "negative_profit_count"]
    metrics = fact_metrics(ctx.star(spark, folder).fact).select(*names)
    return metrics.unpivot([], names, "metric_name", "metric_value")

"""Registered queries: profiles of the staged lines."""

from __future__ import annotations

from salesloom.operators import profiling as pf
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.aggregates import COVERAGE, DISCOUNT_SHARE, REPRICED, described, rounded_description
from salesloom.registry.oracle import on_lines

_TYPES = {
    "segment_name": "string", "country_name": "string", "product_name": "string", "discount_band": "string",
    "units_sold": "decimal(18,2)", "manufacturing_price": "decimal(18,2)", "sale_price": "decimal(18,2)",
    "gross_sales": "decimal(18,2)", "discounts": "decimal(18,2)", "net_sales": "decimal(18,2)",
    "cogs": "decimal(18,2)", "profit": "decimal(18,2)", "transaction_date": "date",
    "month_number": "int", "month_name": "string", "year": "int", "record_source": "string",
}
_NUMBERS = [c for c, t in _TYPES.items() if t.startswith(("decimal", "int"))]


@query(
    "pf1_table_profile",
    on_lines(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, "
            f"count(*) - count({c}) AS null_count, count(*) AS table_rows, "
            f"CAST({len(_TYPES)} AS INTEGER) AS table_columns FROM lines"
            for i, (c, t) in enumerate(_TYPES.items())
        )
    ),
)
def pf1(spark, folder):
    return pf.table_profile(ctx.staged(spark, folder).drop("load_datetime"))


@query("pf1_numeric_summary", on_lines(described(_NUMBERS)))
def pf1_numbers(spark, folder):
    """Statistics of every numeric column."""
    return rounded_description(pf.describe(ctx.staged(spark, folder)))


@query(
    "pf1_duplicate_lines",
    on_lines(
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows "
        "FROM (SELECT count(*) AS n FROM lines GROUP BY "
        + ", ".join(_TYPES)
        + ")"
    ),
)
def pf1_duplicates(spark, folder):
    return pf.duplicate_rows(ctx.staged(spark, folder).drop("load_datetime"))


@query(
    "pf2_categorical_profile",
    on_lines(
        " UNION ALL ".join(
            f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, "
            f"(SELECT count(DISTINCT {c}) FROM lines) AS distinct_values FROM lines WHERE {c} IS NOT NULL "
            f"GROUP BY {c} ORDER BY n DESC, value LIMIT 5)"
            for c in pf.CATEGORIES
        )
    ),
)
def pf2(spark, folder):
    return pf.categorical_profile(ctx.staged(spark, folder))


@query("pf3_date_coverage", COVERAGE)
def pf3(spark, folder):
    return pf.date_coverage(ctx.staged(spark, folder))


@query("pf3_rows_by_year", on_lines("SELECT year, count(*) AS n FROM lines WHERE year IS NOT NULL GROUP BY 1"))
def pf3_years(spark, folder):
    return pf.rows_by_year(ctx.staged(spark, folder))


@query(
    "pf4_sales_trend",
    on_lines(
        "SELECT year, month_number, CAST(sum(net_sales) AS DOUBLE) AS net_sales, "
        "year::VARCHAR || '-' || lpad(month_number::VARCHAR, 2, '0') AS year_month FROM lines GROUP BY 1, 2"
    ),
)
def pf4(spark, folder):
    return pf.sales_trend(ctx.staged(spark, folder))


def _ranked(by: str, measure: str, limit: str = "") -> str:
    return on_lines(
        f"SELECT {by}, CAST(sum({measure}) AS DOUBLE) AS {measure} FROM lines "
        f"WHERE {by} IS NOT NULL GROUP BY 1 "
        f"ORDER BY sum({measure}) DESC, 1 {limit}"
    )


@query("pf5_sales_by_segment", _ranked("segment_name", "net_sales"))
def pf5(spark, folder):
    return pf.ranked_total(ctx.staged(spark, folder), "segment_name", "net_sales")


@query("pf6_top_countries", _ranked("country_name", "net_sales", "LIMIT 10"))
def pf6_countries(spark, folder):
    return pf.ranked_total(ctx.staged(spark, folder), "country_name", "net_sales", 10)


@query("pf6_top_products", _ranked("product_name", "profit", "LIMIT 10"))
def pf6_products(spark, folder):
    return pf.ranked_total(ctx.staged(spark, folder), "product_name", "profit", 10)


@query("pf7_discount_share", DISCOUNT_SHARE)
def pf7(spark, folder):
    return pf.discount_share(ctx.staged(spark, folder))


@query("pf8_repriced_products", REPRICED)
def pf8(spark, folder):
    return pf.repriced_products(ctx.staged(spark, folder))

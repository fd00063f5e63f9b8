"""The six analytical reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions.measures import (
    TOTALS,
    change,
    discount_effectiveness,
    growth_percent,
    percent,
    profit_category,
    ratio,
)
from salesloom.functions.text import quarter_label
from salesloom.operators.ordering import (
    SINGLE_TASK_ROWS,
    row_numbers,
    with_group_totals,
)
from salesloom.plans.cubes import with_cubes
from salesloom.plans.rollup import rollup
from salesloom.plans.warehouse import Star

SUMS = tuple(TOTALS)


def _falling(column: str):
    """Descending with NULL first, as the ranked reports order."""
    return F.col(column).desc_nulls_first()


def _guarded_growth(current: str, previous: str):
    """Growth that is NULL against a missing or zero previous value."""
    return growth_percent(F.col(current), F.col(previous))


def monthly_sales_analysis(star: Star) -> DataFrame:
    """Totals per month with change against the previous month that has sales."""
    months = rollup(star, ["dim_date"], ["year", "month_number", "month_name"])
    # One row per calendar month, so one task is enough.
    by_month = Window.orderBy("year", "month_number")
    previous = {
        "prev_month_net_sales": "net_sales",
        "prev_month_profit": "total_profit",
        "prev_month_units": "units_sold",
    }
    with_previous = months.withColumns({p: F.lag(c).over(by_month) for p, c in previous.items()})
    out = with_previous
    for stem, current, prev in (
        ("net_sales", "net_sales", "prev_month_net_sales"),
        ("profit", "total_profit", "prev_month_profit"),
        ("units", "units_sold", "prev_month_units"),
    ):
        out = out.withColumns(
            {
                f"{stem}_mom_change": change(F.col(current), F.col(prev)),
                f"{stem}_mom_pct_change": _guarded_growth(current, prev),
            }
        )
    moved = [f"{s}_mom_{k}" for s in ("net_sales", "profit", "units") for k in ("change", "pct_change")]
    first = ["gross_sales", "total_discounts", "net_sales", "total_cogs", "total_profit"]
    return out.select(
        "year", "month_number", "month_name", *first, "transaction_count", "units_sold", *previous, *moved
    ).orderBy("year", "month_number")


def product_profitability(star: Star, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Totals, unit economics, three ranks and a margin class per product version."""
    products = rollup(star, ["dim_product"], ["product_key", "product_name", "manufacturing_price"])
    col = F.col
    priced = products.withColumns(
        {
            "profit_per_unit": ratio(col("total_profit"), col("units_sold")),
            "profit_margin_pct": percent(col("total_profit"), col("net_sales")),
            "avg_sale_price": ratio(col("net_sales"), col("units_sold")),
            "discount_pct": percent(col("total_discounts"), col("gross_sales")),
            "profit_category": profit_category(col("total_profit"), col("net_sales")),
        }
    )
    rows = star.size("dim_product")
    ranks = {"profit_rank": "total_profit", "volume_rank": "units_sold", "revenue_rank": "net_sales"}
    for rank, measure in ranks.items():
        priced = row_numbers(
            priced, [_falling(measure), F.col("product_key")], rank, rows=rows, single_task_rows=single_task_rows
        )
    return priced.select(
        "product_key", "product_name", "manufacturing_price", *SUMS, "transaction_count",
        "profit_per_unit", "profit_margin_pct", "avg_sale_price", "discount_pct",
        *ranks, "profit_category",
    ).orderBy(_falling("total_profit"))


def _years(star: Star) -> int:
    return star.size("dim_date") // 365 + 1


def segment_performance(star: Star) -> DataFrame:
    """Totals per segment and quarter, share of the year, growth on the quarter before."""
    quarters = rollup(
        star, ["dim_segment", "dim_date"], ["segment_key", "segment_name", "year", "quarter"]
    )
    shared = with_group_totals(
        quarters,
        ["year"],
        {"_year_sales": "net_sales", "_year_profit": "total_profit"},
        rows=star.size("dim_segment") * 4 * _years(star),
    )
    # The previous quarter restarts each year, so a first quarter never has one.
    in_year = Window.partitionBy("segment_key", "year").orderBy("quarter")
    col = F.col
    return (
        shared.withColumn("prev_quarter_sales", F.lag("net_sales").over(in_year))
        .select(
            "segment_key", "segment_name", "year", "quarter", *SUMS, "transaction_count",
            percent(col("total_profit"), col("net_sales")).alias("profit_margin_pct"),
            percent(col("total_discounts"), col("gross_sales")).alias("discount_pct"),
            percent(col("net_sales"), col("_year_sales")).alias("sales_contribution_pct"),
            percent(col("total_profit"), col("_year_profit")).alias("profit_contribution_pct"),
            "prev_quarter_sales",
            _guarded_growth("net_sales", "prev_quarter_sales").alias("sales_qoq_growth_pct"),
        )
        .orderBy("year", "quarter", _falling("total_profit"))
    )


def geography_performance(star: Star, single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Totals per country and year, share of the region, growth on the calendar year before, ranks."""
    yearly = rollup(
        star, ["dim_geography", "dim_date"], ["geography_key", "country_name", "region", "year"]
    )
    rows = star.size("dim_geography") * _years(star)
    shared = with_group_totals(
        yearly,
        ["region", "year"],
        {"_region_sales": "net_sales", "_region_profit": "total_profit"},
        rows=rows,
        single_task_rows=single_task_rows,
    )
    # One row per country and year: the year before is the row before, if adjacent.
    in_country = Window.partitionBy("geography_key").orderBy("year")
    adjacent = F.lag("year").over(in_country) == F.col("year") - 1
    grown = shared.withColumns(
        {
            "prev_year_sales": F.when(adjacent, F.lag("net_sales").over(in_country)),
            "prev_year_profit": F.when(adjacent, F.lag("total_profit").over(in_country)),
        }
    )
    order = [_falling("total_profit"), F.col("geography_key")]
    sized = {"rows": rows, "single_task_rows": single_task_rows}
    ranked = row_numbers(grown, order, "overall_profit_rank", ["year"], **sized)
    ranked = row_numbers(ranked, order, "region_profit_rank", ["region", "year"], **sized)
    col = F.col
    return ranked.select(
        "geography_key", "country_name", "region", "year", *SUMS, "transaction_count",
        percent(col("total_profit"), col("net_sales")).alias("profit_margin_pct"),
        percent(col("total_discounts"), col("gross_sales")).alias("discount_pct"),
        percent(col("net_sales"), col("_region_sales")).alias("region_sales_contribution_pct"),
        percent(col("total_profit"), col("_region_profit")).alias("region_profit_contribution_pct"),
        "prev_year_sales",
        "prev_year_profit",
        _guarded_growth("net_sales", "prev_year_sales").alias("sales_yoy_growth_pct"),
        _guarded_growth("total_profit", "prev_year_profit").alias("profit_yoy_growth_pct"),
        "overall_profit_rank",
        "region_profit_rank",
    ).orderBy("year", _falling("total_profit"))


def discount_analysis(star: Star) -> DataFrame:
    """Totals per band, product and segment: share of the product, return on discount, class."""
    names = ["discount_key", "discount_band", "product_key", "product_name", "segment_key", "segment_name"]
    cells = rollup(star, ["dim_discount", "dim_product", "dim_segment"], names)
    shared = with_group_totals(
        cells,
        ["product_key"],
        {"_sales": "net_sales", "_profit": "total_profit", "_units": "units_sold"},
        rows=star.size("dim_discount") * star.size("dim_product") * star.size("dim_segment"),
    )
    col = F.col
    profit, discounts = col("total_profit"), col("total_discounts")
    earned = ratio(profit, discounts)
    return shared.select(
        *names, *SUMS, "transaction_count",
        percent(discounts, col("gross_sales")).alias("discount_pct"),
        percent(profit, col("net_sales")).alias("profit_margin_pct"),
        percent(col("net_sales"), col("_sales")).alias("pct_of_product_sales"),
        percent(profit, col("_profit")).alias("pct_of_product_profit"),
        percent(col("units_sold"), col("_units")).alias("pct_of_product_units"),
        ratio(discounts, col("units_sold")).alias("discount_per_unit"),
        earned.alias("profit_per_discount_dollar"),
        F.when((profit > 0) & (discounts > 0), earned).otherwise(F.lit(0.0)).alias("roi_ratio"),
        discount_effectiveness(profit, discounts).alias("discount_effectiveness"),
    ).orderBy("discount_band", _falling("total_profit"))


BOARD_SUMS = ("net_sales", "total_profit", "units_sold", "total_discounts")


def _leaderboard_totals(star: Star) -> dict[str, DataFrame]:
    """Totals per quarter, product, segment, country and band for the dashboard."""
    boards = {
        "quarter": ("dim_date", ["year", "quarter"]),
        "product": ("dim_product", ["product_name"]),
        "segment": ("dim_segment", ["segment_name"]),
        "country": ("dim_geography", ["country_name", "region"]),
        "band": ("dim_discount", ["discount_band"]),
    }
    # All boards read two small sets of totals; without stored ones these are made in one scan each.
    totals = star if star.cubes or star.repeats is None else with_cubes(star)
    return {name: rollup(totals, [dim], by, BOARD_SUMS, None) for name, (dim, by) in boards.items()}


def executive_dashboard(star: Star, top: int = 5) -> DataFrame:
    """One long table: company by quarter, the best products, segments and countries, the bands."""
    totals = _leaderboard_totals(star)
    col = F.col
    margin = percent(col("total_profit"), col("net_sales"))
    unknown = F.lit(None).cast("double")

    # One row per calendar quarter, so one task is enough.
    in_time = Window.orderBy("year", "quarter")
    company = totals["quarter"].withColumn("margin_pct", margin)
    company = company.withColumns(
        {
            "_sales": F.lag("net_sales").over(in_time),
            "_profit": F.lag("total_profit").over(in_time),
            "_margin": F.lag("margin_pct").over(in_time),
        }
    )
    margin_moved = (col("margin_pct") - F.coalesce("_margin", F.lit(0.0))).cast("decimal(38,10)")
    blocks = [
        company.select(
            F.lit("Overall Performance").alias("metric_category"),
            quarter_label(col("year"), col("quarter")).alias("time_period"),
            F.lit("Company").alias("dimension_value"),
            col("net_sales").alias("revenue"),
            col("total_profit").alias("profit"),
            "margin_pct",
            col("units_sold").alias("volume"),
            _guarded_growth("net_sales", "_sales").alias("revenue_pop_pct"),
            _guarded_growth("total_profit", "_profit").alias("profit_pop_pct"),
            F.round(margin_moved, 2).cast("double").alias("margin_pop_delta"),
            F.lit(1).alias("_category"),
            (col("year") * 10 + col("quarter")).alias("_time"),
        )
    ]

    def block(frame: DataFrame, category: str, period, value: str, sort: int, volume) -> DataFrame:
        return frame.select(
            F.lit(category).alias("metric_category"),
            period.alias("time_period"),
            col(value).alias("dimension_value"),
            col("net_sales").alias("revenue"),
            col("total_profit").alias("profit"),
            margin.alias("margin_pct"),
            volume.alias("volume"),
            unknown.alias("revenue_pop_pct"),
            unknown.alias("profit_pop_pct"),
            unknown.alias("margin_pop_delta"),
            F.lit(sort).alias("_category"),
            F.lit(0).alias("_time"),
        )

    def best(name: str, by: str) -> DataFrame:
        return totals[name].orderBy(_falling("total_profit"), by).limit(top)

    always, units = F.lit("All Time"), col("units_sold")
    blocks += [
        block(best("product", "product_name"), "Top Products", always, "product_name", 2, units),
        block(best("segment", "segment_name"), "Top Segments", always, "segment_name", 3, units),
        block(best("country", "country_name"), "Top Countries", col("region"), "country_name", 4, units),
        block(
            totals["band"],
            "Discount Effectiveness",
            discount_effectiveness(col("total_profit"), col("total_discounts")),
            "discount_band",
            5,
            F.lit(None).cast(totals["band"].schema["units_sold"].dataType),
        ),
    ]
    ordered = reduce(DataFrame.unionByName, blocks).orderBy("_category", "_time", _falling("profit"))
    return ordered.drop("_category", "_time")


REPORTS = {
    "monthly_sales_analysis": monthly_sales_analysis,
    "product_profitability": product_profitability,
    "segment_performance": segment_performance,
    "geography_performance": geography_performance,
    "discount_analysis": discount_analysis,
    "executive_dashboard": executive_dashboard,
}


def all_reports(star: Star) -> dict[str, DataFrame]:
    return {name: build(star) for name, build in REPORTS.items()}

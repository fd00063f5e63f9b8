"""Registered queries: scalar functions, each over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.functions import dates as dt
from salesloom.functions.measures import profit_category, quotient, ratio, rounded
from salesloom.functions.text import hashed_key, month_label, parse_amount, parse_day, quarter_label
from salesloom.operators.dimensions import date_spine
from salesloom.operators.quality import status_icon
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import hashed, margin_class, on_lines
from salesloom.registry.oracle import ratio as sql_ratio
from salesloom.schemas import RAW_COLUMNS
from salesloom.sources.files import read_text_csv


def _raw(spark, folder):
    return read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)


def _count(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


@query("sc1_trim", on_lines("SELECT product_name, count(*) AS n FROM lines GROUP BY 1"))
def sc1(spark, folder):
    return _count(_raw(spark, folder), F.trim("Product").alias("product_name"))


@query(
    "sc2_concat",
    on_lines(
        "SELECT 'Business segment for ' || segment_name AS label, "
        "segment_name || CASE WHEN discount_band <> 'None' THEN discount_band END AS pair, count(*) AS n "
        "FROM lines GROUP BY 1, 2"
    ),
)
def sc2(spark, folder):
    """A NULL operand makes the whole text NULL."""
    some = F.when(F.col("discount_band") != "None", F.col("discount_band"))
    return _count(
        ctx.staged(spark, folder),
        F.concat(F.lit("Business segment for "), "segment_name").alias("label"),
        F.concat("segment_name", some).alias("pair"),
    )


@query(
    "sc3_number_to_text",
    on_lines(
        "SELECT CAST(units_sold AS VARCHAR) AS units, CAST(year AS VARCHAR) AS year_text, count(*) AS n "
        "FROM lines GROUP BY 1, 2"
    ),
)
def sc3(spark, folder):
    return _count(
        ctx.staged(spark, folder),
        F.col("units_sold").cast("string").alias("units"),
        F.col("year").cast("string").alias("year_text"),
    )


@query(
    "sc4_replace_and_pad",
    on_lines(
        "SELECT replace(product_name, ' ', '_') AS code, lpad(CAST(month_number AS VARCHAR), 2, '0') AS month, "
        "count(*) AS n FROM lines GROUP BY 1, 2"
    ),
)
def sc4(spark, folder):
    return _count(
        ctx.staged(spark, folder),
        F.replace(F.col("product_name"), F.lit(" "), F.lit("_")).alias("code"),
        F.lpad(F.col("month_number").cast("string"), 2, "0").alias("month"),
    )


@query(
    "sc5_display_format",
    on_lines(
        "SELECT segment_name, format('{:,}', CAST(round(sum(net_sales), 0) AS BIGINT)) AS sales_text, "
        f"printf('%.2f', {sql_ratio('sum(discounts)', 'sum(gross_sales)', '100.0')}) || '%' AS pct_text "
        "FROM lines GROUP BY 1"
    ),
)
def sc5(spark, folder):
    """Thousands separators and a percent sign for labels."""
    share = ratio(F.sum("discounts"), F.sum("gross_sales"), 100.0)
    return ctx.staged(spark, folder).groupBy("segment_name").agg(
        F.format_number(F.round(F.sum("net_sales"), 0), 0).alias("sales_text"),
        F.format_string("%.2f%%", share).alias("pct_text"),
    )


@query(
    "sc6_casts",
    on_lines(
        "SELECT CAST(units_sold AS INTEGER) AS units, month_number, transaction_date, discounts > 0 AS discounted, "
        "count(*) AS n FROM lines GROUP BY 1, 2, 3, 4"
    ),
)
def sc6(spark, folder):
    lines = ctx.staged(spark, folder)
    return _count(
        lines,
        F.col("units_sold").cast("int").alias("units"),
        F.col("month_number").cast("string").cast("int").alias("month_number"),
        F.col("transaction_date").cast("string").cast("date").alias("transaction_date"),
        (F.col("discounts") > 0).cast("string").cast("boolean").alias("discounted"),
    )


@query(
    "sc7_tolerant_parse",
    on_lines(
        "SELECT CAST(CASE WHEN discounts <> 0 THEN discounts END AS DOUBLE) AS discounts, transaction_date, "
        "count(*) AS n FROM lines GROUP BY 1, 2"
    ),
)
def sc7(spark, folder):
    """Unreadable amounts become NULL instead of an error."""
    parsed = _raw(spark, folder).select(
        parse_amount(F.col("Discounts")).alias("discounts"), parse_day(F.col("Date")).alias("transaction_date")
    )
    return _count(parsed, "discounts", "transaction_date")


@query(
    "sc8_coalesce",
    on_lines(
        "SELECT segment_name, CAST(sum(profit) AS DOUBLE) AS profit, "
        "CAST(sum(CASE WHEN discount_band <> 'None' THEN profit ELSE 0 END) AS DOUBLE) AS given "
        "FROM lines GROUP BY 1"
    ),
)
def sc8(spark, folder):
    """A missing profit is recomputed from sales and cost."""
    given = F.when(F.col("discount_band") != "None", F.col("profit"))
    repaired = F.coalesce(given, F.col("net_sales") - F.col("cogs"))
    zero = F.lit(0).cast("decimal(18,2)")
    return ctx.staged(spark, folder).groupBy("segment_name").agg(
        F.sum(repaired).alias("profit"), F.sum(F.coalesce(given, zero)).alias("given")
    )


@query(
    "sc9_nullif",
    on_lines(
        "SELECT discount_band, CAST(sum(nullif(discounts, 0)) AS DOUBLE) AS discounts, "
        "count(nullif(discounts, 0)) AS discounted FROM lines GROUP BY 1"
    ),
)
def sc9(spark, folder):
    some = F.nullif(F.col("discounts"), F.lit(0).cast("decimal(18,2)"))
    return ctx.staged(spark, folder).groupBy("discount_band").agg(
        F.sum(some).alias("discounts"), F.count(some).alias("discounted")
    )


@query(
    "sc10_case_ladder",
    on_lines(f"SELECT {margin_class('profit', 'net_sales')} AS class, count(*) AS n FROM lines GROUP BY 1"),
)
def sc10(spark, folder):
    return _count(
        ctx.staged(spark, folder), profit_category(F.col("profit"), F.col("net_sales")).alias("class")
    )


@query(
    "sc11_round",
    on_lines(
        f"SELECT product_name, units_sold::DOUBLE AS units, {sql_ratio('sum(profit)', 'sum(units_sold)')} AS per_unit "
        "FROM lines GROUP BY 1, units_sold"
    ),
)
def sc11(spark, folder):
    per_unit = rounded(quotient(F.sum("profit"), F.sum("units_sold"))).alias("per_unit")
    lines = ctx.staged(spark, folder)
    return lines.groupBy("product_name", F.col("units_sold").cast("double").alias("units")).agg(per_unit)


@query(
    "sc12_abs",
    on_lines(
        "SELECT segment_name, CAST(sum(abs(profit)) AS DOUBLE) AS moved, CAST(abs(sum(profit)) AS DOUBLE) AS net "
        "FROM lines GROUP BY 1"
    ),
)
def sc12(spark, folder):
    return ctx.staged(spark, folder).groupBy("segment_name").agg(
        F.sum(F.abs("profit")).alias("moved"), F.abs(F.sum("profit")).alias("net")
    )


@query(
    "sc13_date_parts",
    on_lines(
        "SELECT transaction_date, CAST(year(transaction_date) AS INTEGER) AS y, "
        "CAST(quarter(transaction_date) AS INTEGER) AS q, CAST(month(transaction_date) AS INTEGER) AS m, "
        "CAST(day(transaction_date) AS INTEGER) AS d, CAST(dayofweek(transaction_date) AS INTEGER) AS dow, "
        "CAST(dayofyear(transaction_date) AS INTEGER) AS doy, "
        "CAST(weekofyear(transaction_date) AS INTEGER) AS week, count(*) AS n FROM lines GROUP BY 1"
    ),
)
def sc13(spark, folder):
    day = F.col("transaction_date")
    return _count(ctx.staged(spark, folder), "transaction_date").select(
        "transaction_date",
        F.year(day).alias("y"),
        F.quarter(day).alias("q"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        dt.day_of_week(day).alias("dow"),
        F.dayofyear(day).alias("doy"),
        F.weekofyear(day).alias("week"),
        "n",
    )


@query(
    "sc14_date_names",
    on_lines(
        "SELECT CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key, "
        "strftime(transaction_date, '%B') AS month_name, strftime(transaction_date, '%A') AS day_name, "
        "count(*) AS n FROM lines GROUP BY 1, 2, 3"
    ),
)
def sc14(spark, folder):
    day = F.col("transaction_date")
    return _count(
        ctx.staged(spark, folder),
        dt.day_key(day).alias("date_key"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


@query(
    "sc15_first_of_month",
    on_lines(
        "SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS n, "
        "count(*) FILTER (WHERE day(transaction_date) = 1) AS on_first FROM lines GROUP BY 1"
    ),
)
def sc15(spark, folder):
    day = F.col("transaction_date")
    return ctx.staged(spark, folder).groupBy(F.trunc(day, "MM").alias("month")).agg(
        F.count("*").alias("n"), F.count_if(dt.is_first_of_month(day)).alias("on_first")
    )


@query(
    "sc16_last_of_month",
    on_lines(
        "SELECT last_day(transaction_date) AS month_end, count(*) AS n, "
        "count(*) FILTER (WHERE transaction_date = last_day(transaction_date)) AS on_last FROM lines GROUP BY 1"
    ),
)
def sc16(spark, folder):
    day = F.col("transaction_date")
    return ctx.staged(spark, folder).groupBy(F.last_day(day).alias("month_end")).agg(
        F.count("*").alias("n"), F.count_if(dt.is_last_of_month(day)).alias("on_last")
    )


@query(
    "sc17_date_minus_interval",
    on_lines(
        "SELECT CAST(transaction_date - INTERVAL 1 DAY AS DATE) AS day_before, count(*) AS n FROM lines GROUP BY 1"
    ),
)
def sc17(spark, folder):
    return _count(ctx.staged(spark, folder), F.date_sub("transaction_date", 1).alias("day_before"))


@query(
    "sc18_date_spine",
    on_lines(
        """, spine AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))
  AS DATE) AS date_day)
SELECT date_day, count(transaction_date) AS n FROM spine LEFT JOIN lines ON date_day = transaction_date
GROUP BY 1"""
    ),
)
def sc18(spark, folder):
    """Every calendar day with its number of lines, days without sales included."""
    counts = _count(ctx.staged(spark, folder), F.col("transaction_date").alias("date_day"))
    return date_spine(spark, *ctx.SPINE).join(counts, "date_day", "left").fillna(0, ["n"])


@query(
    "sc19_load_time",
    on_lines("SELECT record_source, count(*) AS n, true AS stamped_today FROM lines GROUP BY 1"),
)
def sc19(spark, folder):
    """Rows carry the time they were stamped; only its day is compared, with the current one."""
    from salesloom.operators.staging import stamp_load

    stamped = stamp_load(ctx.staged(spark, folder).drop("load_datetime", "record_source"), "lineitem")
    today = F.to_date("load_datetime") >= F.date_sub(F.current_date(), 1)
    return stamped.groupBy("record_source").agg(
        F.count("*").alias("n"), F.every(today).alias("stamped_today")
    )


@query(
    "sc20_hashed_key",
    on_lines(
        "SELECT "
        + hashed(
            "transaction_date", "product_name", "segment_name", "country_name",
            "CASE WHEN discount_band <> 'None' THEN discount_band END", "units_sold",
        )
        + " AS transaction_id, count(*) AS n FROM lines GROUP BY 1"
    ),
)
def sc20(spark, folder):
    """The row id, with a missing band in some rows."""
    band = F.when(F.col("discount_band") != "None", F.col("discount_band"))
    key = hashed_key(["transaction_date", "product_name", "segment_name", "country_name", band, "units_sold"])
    return _count(ctx.staged(spark, folder), key.alias("transaction_id"))


@query(
    "sc21_period_labels",
    on_lines(
        "SELECT year::VARCHAR || '-Q' || quarter(transaction_date)::VARCHAR AS quarter_label, "
        "CAST(year * 10 + quarter(transaction_date) AS INTEGER) AS period, "
        "year::VARCHAR || '-' || lpad(month_number::VARCHAR, 2, '0') AS month_label, count(*) AS n "
        "FROM lines GROUP BY 1, 2, 3"
    ),
)
def sc21(spark, folder):
    year, quarter = F.col("year"), F.quarter("transaction_date")
    return _count(
        ctx.staged(spark, folder),
        quarter_label(year, quarter).alias("quarter_label"),
        (year * 10 + quarter).alias("period"),
        month_label(year, F.col("month_number")).alias("month_label"),
    )


@query(
    "sc22_status_icon",
    on_lines(
        "SELECT status, CASE status WHEN 'Good' THEN '✅' WHEN 'Warning' THEN '⚠️' WHEN 'Error' THEN '❌' "
        "ELSE '❓' END AS icon, n FROM (SELECT CASE WHEN profit >= net_sales * 0.2 THEN 'Good' "
        "WHEN profit >= 0 THEN 'Warning' WHEN discount_band <> 'High' THEN 'Error' ELSE 'Open' END AS status, "
        "count(*) AS n FROM lines GROUP BY 1)"
    ),
)
def sc22(spark, folder):
    status = (
        F.when(F.col("profit") >= F.col("net_sales") * F.lit(0.2).cast("decimal(2,1)"), "Good")
        .when(F.col("profit") >= 0, "Warning")
        .when(F.col("discount_band") != "High", "Error")
        .otherwise("Open")
    )
    counts = _count(ctx.staged(spark, folder), status.alias("status"))
    return counts.withColumn("icon", status_icon(F.col("status")))

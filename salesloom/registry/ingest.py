"""Registered queries: sources, sinks, staging."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.operators import staging as sg
from salesloom.operators.incremental import upsert
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import on_lines, on_star, sums
from salesloom.schemas import RAW_COLUMNS, STAGING, column_comments
from salesloom.session import scratch_path
from salesloom.sources import files, snapshots, tables

RAW_COUNTS = on_lines(
    "SELECT segment_name AS segment, ' ' || discount_band || ' ' AS band, count(*) AS n, "
    "count(*) FILTER (WHERE discount_band = 'None') AS without_profit FROM lines GROUP BY 1, 2"
)


def _raw_counts(raw):
    return raw.groupBy(F.col("Segment").alias("segment"), F.col("`Discount Band`").alias("band")).agg(
        F.count("*").alias("n"), F.count_if(F.col("Profit").isNull()).alias("without_profit")
    )


@query("src1_csv", RAW_COUNTS)
def src1(spark, folder):
    return _raw_counts(files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS))


@query("src2_first_existing_path", RAW_COUNTS)
def src2(spark, folder):
    """The preferred copy is absent, so the second path is read."""
    paths = [scratch_path(spark, "absent"), ctx.raw_csv(spark, folder)]
    return _raw_counts(files.read_first_csv(spark, paths, RAW_COLUMNS))


@query("src3_landing", RAW_COUNTS)
def src3(spark, folder):
    """Raw rows copied below the landing prefix and read from there."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    return _raw_counts(files.read_text_csv(spark, files.land(raw, scratch_path(spark, "store"), "copy", "gzip")))


def _column_counts(names: dict[str, str]) -> str:
    parts = [f"SELECT '{n}' AS column_name, count({e}) AS present FROM lines" for n, e in names.items()]
    return on_lines(" UNION ALL ".join(parts))


# SQL for the landed content of each raw column: undiscounted lines come without a profit.
PRESENT = {old: new for old, new in sg.RENAMES.items()}
PRESENT["Profit"] = "CASE WHEN discount_band <> 'None' THEN profit END"


def _present(df):
    counts = df.select(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "present")


@query("src4_header_normalisation", _column_counts(PRESENT))
def src4(spark, folder):
    """Column names straight from the padded header line."""
    return _present(files.read_text_csv(spark, ctx.raw_csv(spark, folder)))


@query(
    "src5_declared_source",
    on_lines("SELECT record_source, count(*) AS n, CAST(sum(units_sold) AS DOUBLE) AS units FROM lines GROUP BY 1"),
)
def src5(spark, folder):
    tables.save_view(ctx.staged(spark, folder), "staged_sales")
    source = tables.read_table(spark, "staged_sales")
    return source.groupBy("record_source").agg(F.count("*").alias("n"), F.sum("units_sold").alias("units"))


@query(
    "snk1_cleaned_csv",
    on_lines(
        "SELECT segment_name, month_name, count(*) AS n, CAST(sum(gross_sales) AS DOUBLE) AS gross_sales, "
        "CAST(sum(CASE WHEN discount_band <> 'None' THEN profit END) AS DOUBLE) AS profit "
        "FROM lines GROUP BY 1, 2"
    ),
)
def snk1(spark, folder):
    """Cleaned rows written as CSV and read back with their types."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    cleaned = sg.trim_names(sg.rename_raw(sg.coerce_raw(raw)))
    path = scratch_path(spark, "cleaned")
    files.write_csv(cleaned, path, "gzip")
    from pyspark.sql.types import StructType

    typed = StructType([f for f in STAGING if f.name not in ("load_datetime", "record_source")])
    back = spark.read.schema(typed).option("header", True).csv(path)
    return back.groupBy("segment_name", "month_name").agg(
        F.count("*").alias("n"), F.sum("gross_sales").alias("gross_sales"), F.sum("profit").alias("profit")
    )


YEAR_COUNTS = on_lines(
    "SELECT year, count(*) AS n, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM lines GROUP BY 1"
)


def _year_counts(df):
    return df.groupBy("year").agg(F.count("*").alias("n"), F.sum("net_sales").alias("net_sales"))


@query("snk2_replace_table", YEAR_COUNTS)
def snk2(spark, folder):
    """A second load replaces the first."""
    path, lines = scratch_path(spark, "replaced"), ctx.staged(spark, folder)
    tables.save_table(lines.where(F.col("year") < 1998), path)
    return _year_counts(tables.save_table(lines, path))


@query(
    "snk3_append_load",
    on_lines(
        "SELECT segment_name AS segment, record_source, n FROM (SELECT segment_name, "
        "CASE WHEN year < 1998 THEN 'first file' ELSE 'second file' END AS record_source, "
        "count(*) AS n FROM lines GROUP BY 1, 2)"
    ),
)
def snk3(spark, folder):
    """Two raw files appended to the landed table, each with its own stamp."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    path = scratch_path(spark, "appended")
    early = F.coalesce(F.col("Year").cast("int") < 1998, F.lit(False))
    files.append_raw(raw.where(early), path, "first file")
    files.append_raw(raw.where(~early), path, "second file")
    landed = spark.read.parquet(path)
    return landed.groupBy(F.col("Segment").alias("segment"), "record_source").agg(F.count("*").alias("n"))


@query("snk4_view", YEAR_COUNTS)
def snk4(spark, folder):
    return _year_counts(tables.save_view(ctx.staged(spark, folder), "stg_raw_financials"))


@query(
    "snk5_table",
    on_star(
        f", m AS (SELECT d.year, d.month_number, {sums('f.')} FROM clean f "
        "JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1, 2) "
        "SELECT year, month_number, CAST(net_sales AS DOUBLE) AS net_sales, transaction_count FROM m"
    ),
)
def snk5(spark, folder):
    """A report stored as a table."""
    report = ctx.stored_report(spark, folder, "monthly_sales_analysis")
    return report.select("year", "month_number", "net_sales", "transaction_count")


@query(
    "snk6_incremental_table",
    on_star(
        "SELECT CAST(year(transaction_date) AS INTEGER) AS sale_year, count(DISTINCT transaction_id) AS ids, "
        "count(DISTINCT transaction_id) AS n FROM fact GROUP BY 1"
    ),
)
def snk6(spark, folder):
    """The whole fact merged into its own first half: nothing doubles."""
    fact = ctx.star(spark, folder).fact.drop("sale_year")
    path = scratch_path(spark, "incremental")
    half = fact.where(F.col("transaction_date") < F.lit("1998-06-01").cast("date"))
    from salesloom.operators.facts import deduplicate

    tables.save_by_year(deduplicate(half, "latest"), path)
    merged = upsert(spark, path, fact, policy="latest")
    return merged.groupBy("sale_year").agg(
        F.count_distinct("transaction_id").alias("ids"), F.count("*").alias("n")
    )


@query(
    "snk7_year_partitions",
    on_star(
        "SELECT segment_key, count(*) AS n, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM fact "
        "WHERE date_key >= 19970101 AND date_key < 19980101 GROUP BY 1"
    ),
)
def snk7(spark, folder):
    """One year of the stored fact: the scan lists a single partition."""
    year = ctx.star(spark, folder).fact.where(F.col("sale_year") == 1997)
    return year.groupBy("segment_key").agg(F.count("*").alias("n"), F.sum("net_sales").alias("net_sales"))


_COMMENTS = {
    "transaction_id": "md5 of the natural key",
    "date_key": "key into dim_date",
    "product_key": "key into dim_product",
    "segment_key": "key into dim_segment",
    "geography_key": "key into dim_geography",
    "discount_key": "key into dim_discount",
    "units_sold": "units on the sale line",
    "sale_price": "list price of one unit",
    "gross_sales": "sales before discounts",
    "discounts": "discount amount",
    "net_sales": "sales after discounts",
    "cogs": "cost of goods sold",
    "profit": "net sales less cost of goods",
    "transaction_date": "day of the sale",
    "load_date": "time the line was landed",
    "record_source": "where the line came from",
    "has_missing_keys": "whether a dimension lookup failed",
}


@query(
    "snk8_column_descriptions",
    on_star(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{text}' AS description, "
            f"count({'*' if c == 'load_date' else c}) AS present FROM fact"
            for c, text in _COMMENTS.items()
        )
    ),
)
def snk8(spark, folder):
    """Descriptions of all columns as the stored fact has them, beside the filled values they describe."""
    path = scratch_path(spark, "described")
    snapshots.publish(ctx.star(spark, folder).fact.drop("sale_year"), path)
    fact = tables.read_table(spark, path)
    comments = column_comments(fact)
    described = F.create_map(*[F.lit(x) for c in fact.columns for x in (c, comments.get(c, ""))])
    return _present(fact).select("column_name", described[F.col("column_name")].alias("description"), "present")


UNREADABLE = {c: "count(*) FILTER (WHERE false)" for c in sg.RAW_NUMBER_COLUMNS}
UNREADABLE["Discounts"] = "count(*) FILTER (WHERE discounts = 0)"
UNREADABLE["Month Number"] = UNREADABLE["Year"] = "count(*) FILTER (WHERE transaction_date IS NULL)"
UNREADABLE["Profit"] = "count(*) FILTER (WHERE discount_band = 'None')"


@query(
    "stg1_currency_text",
    on_lines(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {e} AS unreadable FROM lines"
            for c, e in UNREADABLE.items()
        )
    ),
)
def stg1(spark, folder):
    """Currency text to numbers, with the number of failures per column."""
    return sg.unreadable_counts(files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS))


@query(
    "stg1_parsed_amounts",
    on_lines(
        "SELECT product_name, CAST(sum(gross_sales) AS DOUBLE) AS gross_sales, "
        "CAST(sum(CASE WHEN discounts <> 0 THEN discounts END) AS DOUBLE) AS discounts, "
        "CAST(sum(CASE WHEN discount_band <> 'None' THEN profit END) AS DOUBLE) AS profit "
        "FROM lines GROUP BY 1"
    ),
)
def stg1_sums(spark, folder):
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    parsed = sg.coerce_raw(raw)
    return parsed.groupBy(F.trim("Product").alias("product_name")).agg(
        F.sum("`Gross Sales`").alias("gross_sales"),
        F.sum("Discounts").alias("discounts"),
        F.sum("Profit").alias("profit"),
    )


@query("stg2_date_text", on_lines("SELECT transaction_date, count(*) AS n FROM lines GROUP BY 1"))
def stg2(spark, folder):
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    return sg.coerce_raw(raw).groupBy(F.col("Date").alias("transaction_date")).agg(F.count("*").alias("n"))


_DAY_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "dd-MMM-yyyy")


@query("stg2_date_formats", on_lines("SELECT transaction_date, count(*) AS n FROM lines GROUP BY 1"))
def stg2_formats(spark, folder):
    """Days written in five ways, by month."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    day = F.to_date("Date", "M/d/yyyy")
    written = F.date_format(day, _DAY_FORMATS[0])
    for i, pattern in enumerate(_DAY_FORMATS[1:], 1):
        written = F.when(F.month(day) % len(_DAY_FORMATS) == i, F.date_format(day, pattern)).otherwise(written)
    parsed = sg.coerce_raw(raw.withColumn("Date", F.concat(F.lit(" "), written)))
    return parsed.groupBy(F.col("Date").alias("transaction_date")).agg(F.count("*").alias("n"))


@query(
    "stg1_lost_digits",
    on_lines(
        "SELECT 'Gross Sales' AS column_name, count(*) FILTER (WHERE month_number = 1 AND CAST(gross_sales * 100 AS BIGINT) % 8 <> 0) "
        "AS rounded, count(*) FILTER (WHERE month_number = 2) AS too_large FROM lines "
        "UNION ALL SELECT 'Sales', count(*) FILTER (WHERE false), count(*) FILTER (WHERE false) FROM lines"
    ),
)
def stg1_lost(spark, folder):
    """Amounts that have more digits than the staged type: with a third decimal, or above sixteen digits."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    amount = sg.parse_amount(F.col("`Gross Sales`"), "decimal(28,6)")
    month = F.col("Month Number").cast("int")
    longer = F.when(month == 1, F.format_string("$%s", (amount / 8).cast("decimal(28,5)").cast("string")))
    longer = longer.when(month == 2, F.concat(F.lit("1"), F.lpad(F.lit(""), 17, "0"))).otherwise(F.col("`Gross Sales`"))
    lost = sg.lost_digits(raw.withColumn("Gross Sales", longer))
    return lost.where(F.col("column_name").isin("Gross Sales", "Sales"))


@query(
    "stg3_rename",
    _column_counts({new: PRESENT[old] for old, new in sg.RENAMES.items()}),
)
def stg3(spark, folder):
    return _present(sg.rename_raw(files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)))


@query(
    "stg4_trim",
    on_lines("SELECT segment_name, discount_band, month_name, count(*) AS n FROM lines GROUP BY 1, 2, 3"),
)
def stg4(spark, folder):
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    trimmed = sg.trim_names(sg.rename_raw(raw))
    return trimmed.groupBy("segment_name", "discount_band", "month_name").agg(F.count("*").alias("n"))


STAGED = (
    "SELECT segment_name, country_name, product_name, discount_band, CAST(units_sold AS DOUBLE) AS units_sold, "
    "CAST(manufacturing_price AS DOUBLE) AS manufacturing_price, CAST(sale_price AS DOUBLE) AS sale_price, "
    "CAST(gross_sales AS DOUBLE) AS gross_sales, "
    "CAST(CASE WHEN discounts <> 0 THEN discounts END AS DOUBLE) AS discounts, "
    "CAST(net_sales AS DOUBLE) AS net_sales, CAST(cogs AS DOUBLE) AS cogs, "
    "CAST(CASE WHEN discount_band <> 'None' THEN profit END AS DOUBLE) AS profit, "
    "transaction_date, month_number, month_name, year, 'raw_financials' AS record_source FROM lines"
)


@query("stg5_typed_relation", on_lines(STAGED))
def stg5(spark, folder):
    """The complete staging relation from the text file."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    return sg.stage(sg.stamp_load(raw, "raw_financials"))


@query(
    "stg6_load_stamp",
    on_lines(
        "SELECT 'raw_financials' AS record_source, DATE '2002-01-01' AS load_day, segment_name, count(*) AS n "
        "FROM lines GROUP BY 3"
    ),
)
def stg6(spark, folder):
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    staged = sg.stage(sg.stamp_load(raw, "raw_financials", ctx.loaded_at()))
    return staged.groupBy("record_source", F.to_date("load_datetime").alias("load_day"), "segment_name").agg(
        F.count("*").alias("n")
    )


@query(
    "stg_rejected_lines",
    on_lines("SELECT segment_name AS segment, count(*) AS n FROM lines WHERE discounts = 0 GROUP BY 1"),
)
def rejected(spark, folder):
    """Lines with a value that is there but cannot be read."""
    raw = files.read_text_csv(spark, ctx.raw_csv(spark, folder), RAW_COLUMNS)
    return sg.rejected(raw).groupBy(F.col("Segment").alias("segment")).agg(F.count("*").alias("n"))


@query(
    "retail_lines",
    on_lines(
        "SELECT country_name, product_name, count(*) AS n, CAST(sum(sale_price) AS DOUBLE) AS sale_price, "
        "CAST(sum(cogs) AS DOUBLE) AS cogs FROM lines GROUP BY 1, 2"
    ),
)
def retail_lines(spark, folder):
    """The adapter from the retail tables, unstored."""
    from salesloom.sources.retail import sales_lines

    return sales_lines(spark, folder).groupBy("country_name", "product_name").agg(
        F.count("*").alias("n"), F.sum("sale_price").alias("sale_price"), F.sum("cogs").alias("cogs")
    )

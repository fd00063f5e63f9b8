"""Table schemas.  Column descriptions live in the field metadata, which parquet keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in fields])


# The column names of the flat input file.
RAW_COLUMNS = (
    "Segment", "Country", "Product", "Discount Band", "Units Sold", "Manufacturing Price",
    "Sale Price", "Gross Sales", "Discounts", "Sales", "COGS", "Profit",
    "Date", "Month Number", "Month Name", "Year",
)

RAW = _schema(
    ("Segment", T.StringType(), "market segment of the buyer"),
    ("Country", T.StringType(), "country of the sale"),
    ("Product", T.StringType(), "product sold"),
    ("Discount Band", T.StringType(), "band of the granted discount"),
    ("Units Sold", T.StringType(), "units on the sale line"),
    ("Manufacturing Price", T.StringType(), "cost of making one unit"),
    ("Sale Price", T.StringType(), "list price of one unit"),
    ("Gross Sales", T.StringType(), "units times sale price"),
    ("Discounts", T.StringType(), "discount amount of the line"),
    ("Sales", T.StringType(), "gross sales less discounts"),
    ("COGS", T.StringType(), "units times manufacturing price"),
    ("Profit", T.StringType(), "sales less cost of goods"),
    ("Date", T.StringType(), "day of the sale"),
    ("Month Number", T.StringType(), "month of the sale, 1 to 12"),
    ("Month Name", T.StringType(), "name of the month"),
    ("Year", T.StringType(), "year of the sale"),
)

STAGING = _schema(
    ("segment_name", T.StringType(), "market segment of the buyer"),
    ("country_name", T.StringType(), "country of the sale"),
    ("product_name", T.StringType(), "product sold"),
    ("discount_band", T.StringType(), "band of the granted discount"),
    ("units_sold", MONEY, "units on the sale line"),
    ("manufacturing_price", MONEY, "cost of making one unit"),
    ("sale_price", MONEY, "list price of one unit"),
    ("gross_sales", MONEY, "units times sale price"),
    ("discounts", MONEY, "discount amount of the line"),
    ("net_sales", MONEY, "gross sales less discounts"),
    ("cogs", MONEY, "units times manufacturing price"),
    ("profit", MONEY, "net sales less cost of goods; may be missing"),
    ("transaction_date", T.DateType(), "day of the sale"),
    ("month_number", T.IntegerType(), "month of the sale, 1 to 12"),
    ("month_name", T.StringType(), "name of the month"),
    ("year", T.IntegerType(), "year of the sale"),
    ("load_datetime", T.TimestampType(), "time the line was landed"),
    ("record_source", T.StringType(), "where the line came from"),
)

DIM_DATE = _schema(
    ("date_key", T.IntegerType(), "day as YYYYMMDD"),
    ("date_day", T.DateType(), "calendar day"),
    ("day_of_week", T.IntegerType(), "Sunday is 0"),
    ("day_name", T.StringType(), "name of the weekday"),
    ("day_of_month", T.IntegerType(), "1 to 31"),
    ("day_of_year", T.IntegerType(), "1 to 366"),
    ("week_of_year", T.IntegerType(), "ISO week"),
    ("month_number", T.IntegerType(), "1 to 12"),
    ("month_name", T.StringType(), "name of the month"),
    ("quarter", T.IntegerType(), "1 to 4"),
    ("year", T.IntegerType(), "calendar year"),
    ("is_weekend", T.BooleanType(), "whether the weekday counts as weekend"),
    ("is_holiday", T.BooleanType(), "whether the day is a holiday"),
    ("is_first_day_of_month", T.BooleanType(), "first day of its month"),
    ("is_last_day_of_month", T.BooleanType(), "last day of its month"),
)

DIM_SEGMENT = _schema(
    ("segment_key", T.LongType(), "surrogate key"),
    ("segment_name", T.StringType(), "segment, one row each"),
    ("segment_description", T.StringType(), "readable description"),
    ("created_at", T.TimestampType(), "time of the build"),
    ("updated_at", T.TimestampType(), "time of the last rebuild"),
)

DIM_PRODUCT = _schema(
    ("product_key", T.LongType(), "surrogate key of one product version"),
    ("product_name", T.StringType(), "product, one row per price version"),
    ("manufacturing_price", MONEY, "unit cost in this version"),
    ("effective_date", T.DateType(), "first day of the version"),
    ("end_date", T.DateType(), "last day of the version"),
    ("is_current", T.BooleanType(), "whether this is the open version"),
    ("created_at", T.TimestampType(), "time of the build"),
)

DIM_GEOGRAPHY = _schema(
    ("geography_key", T.LongType(), "surrogate key"),
    ("country_name", T.StringType(), "country, one row each"),
    ("region", T.StringType(), "region of the country"),
    ("sub_region", T.StringType(), "part of the region"),
    ("created_at", T.TimestampType(), "time of the build"),
)

DIM_DISCOUNT = _schema(
    ("discount_key", T.LongType(), "surrogate key"),
    ("discount_band", T.StringType(), "band, one row each"),
    ("discount_range_min", T.IntegerType(), "lowest percentage of the band"),
    ("discount_range_max", T.IntegerType(), "highest percentage of the band"),
    ("discount_description", T.StringType(), "readable description"),
    ("created_at", T.TimestampType(), "time of the build"),
)

FACT = _schema(
    ("transaction_id", T.StringType(), "md5 of the natural key"),
    ("date_key", T.IntegerType(), "key into dim_date"),
    ("product_key", T.LongType(), "key into dim_product"),
    ("segment_key", T.LongType(), "key into dim_segment"),
    ("geography_key", T.LongType(), "key into dim_geography"),
    ("discount_key", T.LongType(), "key into dim_discount"),
    ("units_sold", MONEY, "units on the sale line"),
    ("sale_price", MONEY, "list price of one unit"),
    ("gross_sales", MONEY, "sales before discounts"),
    ("discounts", MONEY, "discount amount"),
    ("net_sales", MONEY, "sales after discounts"),
    ("cogs", MONEY, "cost of goods sold"),
    ("profit", MONEY, "net sales less cost of goods"),
    ("transaction_date", T.DateType(), "day of the sale"),
    ("load_date", T.TimestampType(), "time the line was landed"),
    ("record_source", T.StringType(), "where the line came from"),
    ("has_missing_keys", T.BooleanType(), "whether a dimension lookup failed"),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order ``df`` to ``schema``, keeping the column descriptions."""
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema]
    )


def column_comments(df: DataFrame) -> dict[str, str]:
    """Description of every column that has one."""
    return {f.name: f.metadata["comment"] for f in df.schema if "comment" in (f.metadata or {})}

"""From landed text to the typed staging relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.text import parse_amount, parse_day
from salesloom.schemas import STAGING

# raw column -> staging column
RENAMES = {
    "Segment": "segment_name",
    "Country": "country_name",
    "Product": "product_name",
    "Discount Band": "discount_band",
    "Units Sold": "units_sold",
    "Manufacturing Price": "manufacturing_price",
    "Sale Price": "sale_price",
    "Gross Sales": "gross_sales",
    "Discounts": "discounts",
    "Sales": "net_sales",
    "COGS": "cogs",
    "Profit": "profit",
    "Date": "transaction_date",
    "Month Number": "month_number",
    "Month Name": "month_name",
    "Year": "year",
}
TEXT_COLUMNS = ("segment_name", "country_name", "product_name", "discount_band", "month_name")
AMOUNT_COLUMNS = (
    "units_sold", "manufacturing_price", "sale_price", "gross_sales",
    "discounts", "net_sales", "cogs", "profit",
)
WHOLE_COLUMNS = ("month_number", "year")
RAW_NUMBER_COLUMNS = (
    "Units Sold", "Manufacturing Price", "Sale Price", "Gross Sales", "Discounts",
    "Sales", "COGS", "Profit", "Month Number", "Year",
)


def strip_headers(df: DataFrame) -> DataFrame:
    """Drop blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def coerce_raw(raw: DataFrame) -> DataFrame:
    """Parse amounts and dates of the landed text; what cannot be read becomes NULL."""
    whole = {c: parse_amount(F.col(f"`{c}`")).cast("int") for c in ("Month Number", "Year")}
    money = {c: parse_amount(F.col(f"`{c}`")) for c in RAW_NUMBER_COLUMNS if c not in whole}
    return raw.withColumns({**money, **whole, "Date": parse_day(F.col("Date"))})


def unreadable_counts(raw: DataFrame) -> DataFrame:
    """Values per number column that are NULL after coercion, in one pass: ``(column_name, unreadable)``."""
    counts = raw.select(
        *[F.count_if(parse_amount(F.col(f"`{c}`")).isNull()).alias(c) for c in RAW_NUMBER_COLUMNS]
    )
    return counts.unpivot([], list(RAW_NUMBER_COLUMNS), "column_name", "unreadable")


def lost_digits(raw: DataFrame) -> DataFrame:
    """Amounts per column that the staged type cannot hold as they are: ``(column_name, rounded, too_large)``.

    ``rounded`` ones have more than two decimals and are staged to the cent;
    ``too_large`` ones are staged as NULL.  One pass.
    """
    counts = []
    for name in RAW_NUMBER_COLUMNS:
        text = F.col(f"`{name}`")
        staged, exact = parse_amount(text), parse_amount(text, "decimal(38,10)")
        wide = parse_amount(text, "double")
        rounded = F.count_if(staged.isNotNull() & exact.isNotNull() & (exact != staged))
        lost = F.count_if(staged.isNull() & wide.isNotNull() & ~F.isnan(wide))
        counts.append(F.struct(F.lit(name).alias("column_name"), rounded.alias("rounded"), lost.alias("too_large")))
    return raw.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def rename_raw(raw: DataFrame) -> DataFrame:
    """The 16 input columns under their staging names, plus any landing columns."""
    extra = [c for c in raw.columns if c not in RENAMES]
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in RENAMES.items()], *extra)


def stamp_load(df: DataFrame, record_source: str, loaded_at: Column | None = None) -> DataFrame:
    """Add load time and origin; stored at landing so that a later filter on them is stable."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return df.withColumns({"load_datetime": stamp, "record_source": F.lit(record_source)})


def trim_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in TEXT_COLUMNS})


def typed(df: DataFrame) -> DataFrame:
    """Cast every column to its staging type; an unreadable value is an error here."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in STAGING]
    )


def stage(landed: DataFrame, tolerant: bool = True) -> DataFrame:
    """The staging relation over landed rows (raw column names, load stamp present).

    ``tolerant`` turns unreadable numbers and dates into NULL, as the cleaning
    step before the load does; otherwise they raise.
    """
    rows = coerce_raw(landed) if tolerant else landed
    return typed(trim_names(rename_raw(rows)))


def rejected(landed: DataFrame) -> DataFrame:
    """Landed rows with at least one value that is present but cannot be read."""
    readable = {
        **{c: parse_amount(F.col(f"`{c}`")) for c in RAW_NUMBER_COLUMNS},
        "Date": parse_day(F.col("Date")),
    }
    bad = F.lit(False)
    for name, value in readable.items():
        bad = bad | (F.col(f"`{name}`").isNotNull() & value.isNull())
    return landed.where(bad)

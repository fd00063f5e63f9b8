"""Sales lines in the shape of the flat text file: padded headers, currency text, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Headers as they arrive, with stray blanks.
HEADERS = (
    "Segment", "Country", " Product ", " Discount Band ", " Units Sold ", " Manufacturing Price ",
    " Sale Price ", " Gross Sales ", " Discounts ", "  Sales ", " COGS ", " Profit ",
    "Date", "Month Number", " Month Name ", "Year",
)


def money_text(amount: Column) -> Column:
    return F.concat(F.lit(" $"), F.format_number(amount, 2), F.lit(" "))


def raw_text(lines: DataFrame) -> DataFrame:
    """Zero discounts read ``$-``; undiscounted lines come without a profit."""
    c = F.col
    columns = [
        c("segment_name"),
        c("country_name"),
        F.concat(F.lit(" "), "product_name", F.lit(" ")),
        F.concat(F.lit(" "), "discount_band", F.lit(" ")),
        F.concat(F.lit(" "), F.format_number("units_sold", 2), F.lit(" ")),
        money_text(c("manufacturing_price")),
        money_text(c("sale_price")),
        money_text(c("gross_sales")),
        F.when(c("discounts") == 0, " $-   ").otherwise(money_text(c("discounts"))),
        money_text(c("net_sales")),
        money_text(c("cogs")),
        F.when(c("discount_band") != "None", money_text(c("profit"))),
        F.date_format("transaction_date", "M/d/yyyy"),
        c("month_number").cast("string"),
        F.concat(F.lit(" "), "month_name", F.lit(" ")),
        c("year").cast("string"),
    ]
    return lines.select(*[value.alias(header) for value, header in zip(columns, HEADERS)])

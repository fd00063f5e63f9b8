import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesloom.schemas import STAGING  # noqa: E402
from salesloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


LINE = {
    "segment_name": "Retail",
    "country_name": "France",
    "product_name": "Lamp",
    "discount_band": "Low",
    "units_sold": 10,
    "manufacturing_price": 3,
    "sale_price": 7,
    "gross_sales": 70,
    "discounts": 5,
    "net_sales": 65,
    "cogs": 30,
    "profit": 35,
    "transaction_date": date(2014, 1, 1),
    "load_datetime": datetime(2020, 1, 1),
    "record_source": "test",
}
MONEY_FIELDS = (
    "units_sold", "manufacturing_price", "sale_price", "gross_sales", "discounts", "net_sales", "cogs", "profit",
)


@pytest.fixture(scope="session")
def lines(spark):
    """Build staged lines from a few changed fields each."""

    def make(*changes):
        rows = []
        for change in changes:
            row = {**LINE, **change}
            day = row["transaction_date"]
            row["month_number"] = day and day.month
            row["month_name"] = day and day.strftime("%B")
            row["year"] = day and day.year
            row.update({f: money(row[f]) for f in MONEY_FIELDS})
            rows.append(tuple(row[f.name] for f in STAGING))
        return spark.createDataFrame(rows, STAGING)

    return make


@pytest.fixture(scope="session")
def rows_of():
    def collect(df, *columns):
        names = columns or df.columns
        return sorted([tuple(r[c] for c in names) for r in df.collect()], key=str)

    return collect

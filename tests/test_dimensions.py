from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.operators import dimensions as dm


def test_calendar(spark):
    days = dm.dim_date(spark)
    assert days.count() == 7669
    last = days.agg(F.max("date_day")).first()[0]
    assert last == date(2030, 12, 30)
    row = {r["date_day"]: r for r in days.where("date_key between 20240223 and 20240301").collect()}
    friday, saturday, sunday = (row[date(2024, 2, d)] for d in (23, 24, 25))
    assert [r["is_weekend"] for r in (friday, saturday, sunday)] == [True, True, False]
    assert [r["day_of_week"] for r in (friday, saturday, sunday)] == [5, 6, 0]
    leap = row[date(2024, 2, 29)]
    assert leap["is_last_day_of_month"] and not leap["is_first_day_of_month"]
    assert leap["day_name"] == "Thursday" and leap["month_name"] == "February"
    assert row[date(2024, 3, 1)]["is_first_day_of_month"] and not leap["is_holiday"]


def test_calendar_options(spark):
    holidays = spark.createDataFrame([(date(2024, 2, 26),)], "date_day date")
    days = dm.dim_date(spark, "2024-02-23", "2024-02-27", weekend_days=(6, 0), holidays=holidays)
    got = {r["date_day"].day: (r["is_weekend"], r["is_holiday"]) for r in days.collect()}
    assert got == {23: (False, False), 24: (True, False), 25: (True, False), 26: (False, True)}
    with pytest.raises(ValueError):
        dm.dim_date(spark, "2024-01-01", "2024-01-01")


def test_segments(lines):
    got = dm.dim_segment(lines({"segment_name": "B"}, {"segment_name": "A"}, {"segment_name": None}, {"segment_name": "B"}))
    rows = sorted((r["segment_key"], r["segment_name"], r["segment_description"]) for r in got.collect())
    assert rows == [(1, "A", "Business segment for A"), (2, "B", "Business segment for B")]


def test_keys_stay_when_extending(lines):
    old = dm.dim_segment(lines({"segment_name": "B"}, {"segment_name": "D"}))
    new = dm.dim_segment(
        lines(*[{"segment_name": s} for s in ("A", "B", "C", "D")]), existing=old
    )
    assert {r["segment_name"]: r["segment_key"] for r in new.collect()} == {"B": 1, "D": 2, "A": 3, "C": 4}


def test_geography(lines):
    got = dm.dim_geography(lines(*[{"country_name": c} for c in ("Mexico", "India", "Atlantis", None)]))
    rows = {r["country_name"]: (r["geography_key"], r["region"], r["sub_region"]) for r in got.collect()}
    assert rows == {
        "Atlantis": (1, "Other", "Other"),
        "India": (2, "Asia", "South Asia"),
        "Mexico": (3, "North America", "Central America"),
    }


def test_discount(lines):
    got = dm.dim_discount(lines(*[{"discount_band": b} for b in ("None", "High", "Promo", None)]))
    rows = {r["discount_band"]: tuple(r)[2:5] for r in got.collect()}
    assert rows == {
        "High": (30, 50, "High discount between 30-50%"),
        "None": (0, 0, "No discount applied"),
        "Promo": (0, 0, "Unknown discount type"),
    }


PRICES = [
    ("Lamp", 3, date(2014, 1, 1)),
    ("Lamp", 4, date(2014, 3, 1)),
    ("Lamp", 3, date(2014, 5, 1)),
    ("Desk", 9, date(2014, 2, 1)),
    ("Desk", 8, date(2014, 2, 1)),
]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_product_versions(lines, limit):
    staged = lines(
        *[{"product_name": n, "manufacturing_price": p, "transaction_date": d} for n, p, d in PRICES],
        {"product_name": None},
    )
    got = dm.dim_product(staged, single_task_rows=limit).orderBy("product_key").collect()
    assert [
        (r["product_key"], r["product_name"], int(r["manufacturing_price"]), r["effective_date"], r["end_date"], r["is_current"])
        for r in got
    ] == [
        # equal start dates: ordered by price, the first interval is empty
        (1, "Desk", 8, date(2014, 2, 1), date(2014, 1, 31), False),
        (2, "Desk", 9, date(2014, 2, 1), date(9999, 12, 30), True),
        # the price that came back is not a version of its own
        (3, "Lamp", 3, date(2014, 1, 1), date(2014, 2, 28), False),
        (4, "Lamp", 4, date(2014, 3, 1), date(9999, 12, 30), True),
    ]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_product_keys_stay_when_extending(lines, limit):
    def product(price, day):
        return {"manufacturing_price": price, "transaction_date": day}

    first = [product(5, date(2014, 2, 1)), product(6, date(2014, 3, 1))]
    old = dm.dim_product(lines(*first))
    late = product(4, date(2014, 1, 1))
    new = dm.dim_product(lines(*first, late), existing=old, single_task_rows=limit)
    got = {int(r["manufacturing_price"]): (r["product_key"], r["is_current"], r["end_date"]) for r in new.collect()}
    assert got == {
        4: (3, False, date(2014, 1, 31)),
        5: (1, False, date(2014, 2, 28)),
        6: (2, True, date(9999, 12, 30)),
    }


def test_exactly_one_current_version_and_no_overlap(lines):
    days = [date(2014, m, 1) for m in range(1, 13)]
    staged = lines(
        *[
            {"product_name": f"P{i % 3}", "manufacturing_price": i, "transaction_date": d}
            for i, d in enumerate(days)
        ]
    )
    dim = dm.dim_product(staged)
    current = dim.where("is_current").groupBy("product_name").count()
    assert {r["count"] for r in current.collect()} == {1} and current.count() == 3
    a, b = dim.alias("a"), dim.alias("b")
    overlaps = a.join(
        b,
        (F.col("a.product_name") == F.col("b.product_name"))
        & (F.col("a.product_key") < F.col("b.product_key"))
        & (F.col("a.end_date") >= F.col("b.effective_date")),
    )
    assert overlaps.count() == 0

import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.functions import measures as ms
from salesloom.functions import text as tx


@pytest.mark.parametrize(
    "text, expected",
    [
        (" $1,618.50 ", Decimal("1618.50")),
        ("$-", None),
        (" $-   ", None),
        ("-12.30", Decimal("-12.30")),
        ("", None),
        (None, None),
        ("abc", None),
        ("1,000,000", Decimal("1000000.00")),
    ],
)
def test_parse_amount(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.parse_amount(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [("2014-06-01", date(2014, 6, 1)), (" 6/1/2014 ", date(2014, 6, 1)), ("soon", None), (None, None)],
)
def test_parse_day(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.parse_day(F.col("t"))).first()[0] == expected


def test_parse_day_tries_a_format_on_text_with_its_separators_only(spark):
    texts = [
        "2014-06-01", "6/1/2014", "2014-06-01 10:11:12", "2014/06/01", "01-Jun-2014", "2014", "2014-06", "6/1-2014", "-/:",
        "13/13/2014", "2014-02-30", "", None, "20140601", "2014-06-01T10:11:12",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for formats in (tx.DAY_FORMATS, ("yyyy[-MM]", "yyyyMMdd"), ("yyyy-MM-dd'T'HH:mm:ss",)):
        plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)).cast("date") for f in formats])
        rows = df.select(tx.parse_day(F.col("t"), formats).alias("found"), plain.alias("wanted")).collect()
        assert [r.found for r in rows] == [r.wanted for r in rows]
    plan = df.select(tx.parse_day(F.col("t")).alias("day"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains(") == sum(len(set(f) & set("-/:")) for f in tx.DAY_FORMATS)


def test_hashed_key_marks_missing_fields(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    expected = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-c").hexdigest()
    assert df.select(tx.hashed_key(["x", "y", "z"])).first()[0] == expected
    swapped = df.select(tx.hashed_key(["y", "x", "z"])).first()[0]
    assert swapped != expected


def test_labels(spark):
    df = spark.createDataFrame([(2014, 3, 2)], "y int, m int, q int")
    row = df.select(
        tx.quarter_label(F.col("y"), F.col("q")), tx.month_label(F.col("y"), F.col("m"))
    ).first()
    assert tuple(row) == ("2014-Q2", "2014-03")


@pytest.mark.parametrize("value, expected", [(1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (None, None)])
def test_rounding_half_away_from_zero(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(ms.rounded(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("n, d, expected", [(1, 3, 33.33), (5, 0, None), (None, 3, None), (-1, 3, -33.33)])
def test_percent(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n int, d int")
    assert df.select(ms.percent(F.col("n"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    "profit, net, expected",
    [
        (20, 100, "High Margin"),
        (19, 100, "Medium Margin"),
        (10, 100, "Medium Margin"),
        (9, 100, "Low Margin"),
        (0, 100, "Low Margin"),
        (-1, 100, "Loss Making"),
        (5, 0, "Loss Making"),
    ],
)
def test_profit_category(spark, profit, net, expected):
    df = spark.createDataFrame([(profit, net)], "p int, n int")
    assert df.select(ms.profit_category(F.col("p"), F.col("n"))).first()[0] == expected


@pytest.mark.parametrize(
    "profit, discounts, expected",
    [
        (30, 10, "Highly Effective"),
        (10, 10, "Effective"),
        (9, 10, "Ineffective"),
        (0, 10, "Loss Making"),
        (5, 0, "Ineffective"),
    ],
)
def test_discount_effectiveness(spark, profit, discounts, expected):
    df = spark.createDataFrame([(profit, discounts)], "p int, d int")
    assert df.select(ms.discount_effectiveness(F.col("p"), F.col("d"))).first()[0] == expected


def test_classes_at_exact_bounds(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from salesloom.functions.measures import discount_effectiveness, profit_category

    rows = [("0.30", "1.50"), ("0.30", "3.00"), ("1.20", "0.40"), ("-0.30", "-1.50"), ("-1", "5"), ("1", "0"), ("0.29", "1.50"), ("1", "-5")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "a decimal(18,2), b decimal(18,2)")
    found = df.select(profit_category(F.col("a"), F.col("b")), discount_effectiveness(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [
        "High Margin", "Medium Margin", "High Margin", "High Margin", "Loss Making", "Loss Making", "Medium Margin", "Loss Making",
    ]
    assert found[2][1] == "Highly Effective"

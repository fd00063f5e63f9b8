"""The version valid on a day by both routes, and versions by change runs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salesloom.operators import history
from salesloom.operators.dimensions import dim_date, dim_discount, dim_geography, dim_product, dim_segment
from salesloom.operators.facts import sales_fact

ROUTES = {"searched": {}, "sorted": {"most_in_row": 0, "share": 1}, "sliced": {"most_in_row": 0, "share": 10_000}}


def day(n):
    return date(2014, 1, 1) + timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    versions = [("a", day(5), 1), ("a", day(9), 2), ("a", day(9), 3), ("b", day(0), 4), (None, day(0), 5), ("b", None, 6)]
    versions += [("hot", day(rng.randrange(300)), 100 + i) for i in range(60)]
    rows = [("a", day(4)), ("a", day(5)), ("a", day(8)), ("a", day(9)), ("a", day(400)), ("b", day(0)), ("b", day(-1))]
    rows += [("c", day(9)), (None, day(9)), ("a", None), ("a", day(9))]
    rows += [("hot", day(rng.randrange(-20, 320))) for _ in range(600)] + [("hot", day(150))] * 400
    made = [(p, d, i, p) for i, (p, d) in enumerate(rows)]
    right = spark.createDataFrame(versions, "product string, starts date, version int")
    # Clashing column names of the rows do not matter.
    return spark.createDataFrame(made, "product string, at date, _kind int, _group string").repartition(7), right, made, versions


@pytest.mark.parametrize("route", ROUTES)
def test_as_of(spark, tables, route):
    rows, versions, made, listed = tables
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = history.as_of(rows, versions, "product", "at", "starts", ["version"], tie=["version"], **ROUTES[route])
        got = {r["_kind"]: r["version"] for r in found.collect()}
        assert found.columns == ["product", "at", "_kind", "_group", "version"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def wanted(product, at):
        begun = [(s, v) for p, s, v in listed if None not in (p, s, at, product) and p == product and s <= at]
        return max(begun)[1] if begun else None

    assert got == {i: wanted(p, d) for p, d, i, _ in made}


@pytest.mark.parametrize("route", ROUTES)
def test_as_of_takes_empty_tables(tables, route):
    rows, versions, made, _ = tables
    args = ("product", "at", "starts", ["version"])
    assert history.as_of(rows.limit(0), versions, *args, **ROUTES[route]).count() == 0
    bare = history.as_of(rows, versions.limit(0), *args, **ROUTES[route])
    assert bare.count() == len(made) and bare.where("version is not null").count() == 0


def test_no_range_join_in_the_plan(tables):
    rows, versions, _, _ = tables
    for options in ROUTES.values():
        found = history.as_of(rows, versions, "product", "at", "starts", ["version"], **options)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_only_look_up_their_day(spark, tables, monkeypatch):
    rows, versions, made, _ = tables
    sorted_rows, carried = [], history._carried

    def counted(found, *args):
        sorted_rows.append(found.count())
        return carried(found, *args)

    monkeypatch.setattr(history, "_carried", counted)
    found = history.as_of(rows, versions, "product", "at", "starts", ["version"], most_in_row=0)
    assert found.count() == len(made)
    days = {(p, d) for p, d, _, _ in made if None not in (p, d)}
    assert sum(sorted_rows) == len(days) + versions.where("product is not null and starts is not null").count()
    # A row carries no more than its own columns through the plan, and no shuffle moves it.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fact_at_the_version_of_the_day(spark, lines):
    sold = lines(
        {"manufacturing_price": 3},
        {"manufacturing_price": 4, "transaction_date": day(10)},
        {"manufacturing_price": 3, "transaction_date": day(20)},
        {"manufacturing_price": None, "transaction_date": day(10)},
        {"product_name": None},
    )
    dims = {
        "dim_date": dim_date(spark, "2014-01-01", "2015-01-01"),
        "dim_product": dim_product(sold),
        "dim_segment": dim_segment(sold),
        "dim_geography": dim_geography(sold),
        "dim_discount": dim_discount(sold),
    }
    keys = {
        (r["product_name"], r["manufacturing_price"] and int(r["manufacturing_price"])): r["product_key"]
        for r in dims["dim_product"].collect()
    }
    fact = sales_fact(sold, dims, product_join="as_of").collect()
    got = sorted((r["transaction_date"], r["product_key"] or 0) for r in fact)
    # The missing price is the last of the versions that start on its day.
    last = keys["Lamp", None]
    assert got == [(day(0), 0), (day(0), keys["Lamp", 3]), (day(10), last), (day(10), last), (day(20), last)]
    current = sales_fact(sold, dims).where("product_key is not null").select("product_key").distinct().collect()
    assert [r[0] for r in current] == [last]
    with pytest.raises(ValueError):
        sales_fact(sold, dims, product_join="some day")


def test_change_runs(spark, lines):
    prices = [(0, 3), (2, 3), (5, 4), (7, 3), (9, None), (10, None), (12, 3)]
    rows = [{"transaction_date": day(d), "manufacturing_price": p} for d, p in prices]
    # A day with several prices takes that of most lines, of equally many the lowest.
    rows += [{"transaction_date": day(5), "manufacturing_price": p} for p in (4, 9, 8)]
    rows += [{"transaction_date": day(20), "manufacturing_price": p} for p in (7, 6, None)]
    rows += [{"product_name": None}, {"product_name": "Vase", "transaction_date": None}, {"product_name": "Vase"}]
    found = history.change_runs(lines(*rows)).orderBy("product_name", "version_number").collect()
    got = [
        (r["product_name"], r["version_number"], r["manufacturing_price"] and int(r["manufacturing_price"]),
         r["effective_date"], r["end_date"], r["days"], r["is_current"])
        for r in found
    ]
    assert got == [
        ("Lamp", 1, 3, day(0), day(4), 2, False),
        ("Lamp", 2, 4, day(5), day(6), 1, False),
        ("Lamp", 3, 3, day(7), day(8), 1, False),
        ("Lamp", 4, None, day(9), day(11), 2, False),
        ("Lamp", 5, 3, day(12), day(19), 1, False),
        ("Lamp", 6, 6, day(20), None, 1, True),
        ("Vase", 1, 3, day(0), None, 1, True),
    ]
    assert history.change_runs(lines({}).limit(0)).count() == 0


def test_change_runs_of_a_product_on_every_line(spark, lines):
    base = lines({"product_name": "hot"})
    many = base.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(19_999))))
    at = F.date_add(F.col("transaction_date"), (F.col("i") % 365).cast("int"))
    price = F.when((F.col("i") % 365) < 100, 1).when((F.col("i") % 365) < 200, 2).otherwise(1)
    sold = many.withColumns({"transaction_date": at, "manufacturing_price": price.cast("decimal(18,2)")}).drop("i")
    runs = history.change_runs(sold).orderBy("version_number").collect()
    assert [(r["effective_date"], r["days"]) for r in runs] == [(day(0), 100), (day(100), 100), (day(200), 165)]

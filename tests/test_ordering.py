"""The distributed routes must equal the single-task ones, and both brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.operators.counting import counts_by_value, repeated_values, surplus_rows
from salesloom.operators.ordering import row_numbers, running_totals, with_group_totals
from salesloom.operators.quantiles import exact_quantiles

ROUTES = (10**6, 0)


@pytest.fixture(scope="module")
def numbers(spark):
    """1,000 rows; group ``a`` holds a third of them and one group is NULL."""
    rnd = random.Random(7)
    groups = ["a", "a", "a", "b", "c", "d", None, "e", "f"]
    data = [(i, groups[i % 9], rnd.randint(0, 50), rnd.randint(1, 9)) for i in range(1000)]
    return data, spark.createDataFrame(data, "id int, g string, v int, n bigint").repartition(5)


@pytest.mark.parametrize("limit", ROUTES)
def test_row_numbers(numbers, limit):
    data, df = numbers
    out = row_numbers(df, [F.desc("v"), F.col("id")], "r", single_task_rows=limit)
    assert dict(out.dtypes)["r"] == "bigint" and out.columns == [*df.columns, "r"]
    expected = {row[0]: i + 1 for i, row in enumerate(sorted(data, key=lambda r: (-r[2], r[0])))}
    assert {r["id"]: r["r"] for r in out.collect()} == expected


@pytest.mark.parametrize("limit", ROUTES)
def test_row_numbers_in_groups(numbers, limit):
    data, df = numbers
    out = row_numbers(df, [F.col("v"), F.col("id")], "r", ["g"], single_task_rows=limit)
    expected = {}
    for g in {r[1] for r in data}:
        for i, row in enumerate(sorted((r for r in data if r[1] == g), key=lambda r: (r[2], r[0]))):
            expected[row[0]] = i + 1
    assert {r["id"]: r["r"] for r in out.collect()} == expected


@pytest.mark.parametrize("limit", ROUTES)
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_totals(numbers, limit, groups):
    data, df = numbers
    out = running_totals(df, ["v", "id"], "n", "upto", groups, single_task_rows=limit)
    expected, sums = {}, Counter()
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        key = row[1] if groups else 0
        sums[key] += row[3]
        expected[row[0]] = sums[key]
    assert {r["id"]: r["upto"] for r in out.collect()} == expected


@pytest.mark.parametrize("limit", ROUTES)
def test_group_totals(numbers, limit):
    data, df = numbers
    out = with_group_totals(df, ["g"], {"t": "n"}, rows=1000, single_task_rows=limit)
    sums = Counter()
    for r in data:
        sums[r[1]] += r[3]
    assert {r["id"]: r["t"] for r in out.collect()} == {r[0]: sums[r[1]] for r in data}


@pytest.mark.parametrize("limit", ROUTES)
def test_exact_quantiles(numbers, limit):
    data, df = numbers
    holed = df.withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v")))
    out = exact_quantiles(holed, ["v", "n"], (0.25, 0.5, 0.9), single_task_rows=limit)
    got = {(r["column_name"], r["probability"]): r["quantile"] for r in out.collect()}
    values = {"v": [r[2] for r in data if r[0] % 10], "n": [r[3] for r in data]}
    for (column, p), value in got.items():
        assert value == pytest.approx(np.quantile(values[column], p)), (column, p)
    assert len(got) == 6


def test_counts_by_value(numbers):
    data, df = numbers
    got = {(r["column_name"], r["value"]): r["n"] for r in counts_by_value(df, ["g", "v"], "string").collect()}
    expected = Counter(("g", r[1]) for r in data) + Counter(("v", str(r[2])) for r in data)
    assert got == dict(expected)


def test_repeats(numbers):
    data, df = numbers
    expected = {k: n for k, n in Counter((r[1], r[2]) for r in data).items() if n > 1}
    got = {(r["g"], r["v"]): r["_copies"] for r in repeated_values(df, ["g", "v"]).collect()}
    assert got == expected
    assert surplus_rows(df, ["g", "v"], "s").first()["s"] == sum(n - 1 for n in expected.values())
    tripled = df.select("g", "v", "n").unionByName(df.select("g", "v", "n")).unionByName(df.select("g", "v", "n"))
    distinct = len({(r[1], r[2], r[3]) for r in data})
    assert surplus_rows(tripled, ["g", "v", "n"], "s").first()["s"] == 3000 - distinct
    assert surplus_rows(df, ["id"], "s").first()["s"] == 0


def test_running_totals_with_negatives_zeros_and_nulls(spark):
    from salesloom.operators.ordering import running_totals

    rows = [("a", 1, 5), ("a", 2, -9), ("a", 3, 2), ("b", 1, None), ("b", 2, 0), ("b", 3, -4), ("c", 1, None)]
    rows += [(None, 1, -1), (None, 2, 3)]
    df = spark.createDataFrame(rows, "g string, n long, amount long")
    for groups in (["g"], []):
        order = ["n"] if groups else ["g", "n"]
        results = [
            sorted(map(tuple, running_totals(df, order, "amount", "total", groups, single_task_rows=limit).collect()), key=str)
            for limit in (1_000_000, 0)
        ]
        assert results[0] == results[1]

"""Declared rules, quantiles by brackets, totals kept beside the fact, checks in two scans."""

import random
import re
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.functions.text import parse_day
from salesloom.operators import quality as dq
from salesloom.operators import rules
from salesloom.operators.merging import merge_fact
from salesloom.operators.quantiles import exact_quantiles
from salesloom.operators.staging import lost_digits
from salesloom.plans import cubes, reports
from salesloom.plans import rollup as rollups
from salesloom.plans.cubes import with_cubes
from salesloom.plans.rollup import rollup
from salesloom.plans.warehouse import FACT_TABLE, Settings, Star, build_star, load_star, star_of
from salesloom.registry.texts import raw_text
from salesloom.session import checkpointed
from salesloom.sources import snapshots

SPAN = Settings("2014-01-15", "2017-01-01", policy="keep_all", buckets=2)


@pytest.fixture(scope="module")
def sold(lines):
    rng = random.Random(9)
    rows = [
        {
            "transaction_date": date(2014, 1, 10) + timedelta(days=rng.randrange(1000)),
            "product_name": rng.choice("ABCD"),
            "segment_name": rng.choice(["S", "T"]),
            "country_name": rng.choice(["France", "Chile", "Spain"]),
            "discount_band": rng.choice(["Low", "None"]),
            "units_sold": rng.randrange(3),
            "net_sales": rng.randrange(50),
            "cogs": rng.choice([None, 3]),
        }
        for _ in range(400)
    ]
    return lines(*rows)


@pytest.fixture(scope="module")
def star(spark, sold, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star"))
    build_star(sold, path, SPAN)
    return load_star(spark, path)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_identities_and_severity(lines):
    good = {"units_sold": 10, "sale_price": 7, "gross_sales": 70, "discounts": 5, "net_sales": 65,
            "manufacturing_price": 3, "cogs": 30, "profit": 35}
    sold = lines(
        good,
        {**good, "gross_sales": "70.05", "net_sales": "65.05", "profit": "35.05"},  # the price is rounded to cents
        {**good, "gross_sales": "70.06", "net_sales": "65.06", "profit": "35.06"},
        {**good, "net_sales": "65.01", "profit": "35.01"},
        {**good, "cogs": 31, "profit": 34},
        {**good, "profit": 36},
        {**good, "profit": None, "discounts": None},
    )
    found = {r["rule"]: (r["severity"], r["violations"], r["table_rows"]) for r in rules.violations(sold, rules.IDENTITIES).collect()}
    assert found == {
        "gross_is_units_times_price": ("error", 1, 7),
        "net_is_gross_less_discounts": ("error", 1, 7),
        "cogs_is_units_times_cost": ("error", 1, 7),
        "profit_is_net_less_cogs": ("error", 1, 7),
    }
    broken = rules.broken_rows(sold, rules.IDENTITIES).select("broken_rules").collect()
    assert sorted(r[0][0] for r in broken) == sorted(found) and all(len(r[0]) == 1 for r in broken)
    strict = rules.Rule("known_profit", "profit < 0", "warn", unknown_breaks=True)
    assert rules.violations(sold, [strict]).first()["violations"] == 1
    assert [r["violations"] for r in rules.violations(sold.limit(0), rules.IDENTITIES).collect()] == [0] * 4


def test_rules_counted_by_the_write(spark, lines, tmp_path):
    sold = lines({}, {"profit": 1}, {"profit": 2})
    watched, seen = rules.observed(sold.repartition(3), rules.IDENTITIES)
    snapshots.publish(watched, str(tmp_path / "t"))
    assert seen.get["_rows"] == 3 and seen.get["profit_is_net_less_cogs"] == 2


def test_checks_scan_the_fact_twice(star):
    """The counts come from two jobs over the fact, and what is built on them reads stored rows."""
    counted = dq.count_fact(star)
    for frame in (counted.tallies, counted.keys, counted.repeats):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" not in plan
    checks = dq.run_checks(star, reports.all_reports(star))
    scans = checks._jdf.queryExecution().optimizedPlan().toString().count("sale_year")
    assert scans <= 2  # the probe for a first row


def test_counts_with_and_without_surplus_rows_agree(star):
    bare = Star(star.fact, star.dims)
    assert star.repeats is not None
    for kept, counted in zip(dq.count_fact(star).__dict__.values(), dq.count_fact(bare).__dict__.values()):
        assert rows_of(kept) == rows_of(counted)


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_reports_from_cubes_equal_reports_from_the_fact(star, name):
    assert set(star.cubes) == set(cubes.CUBES)
    plain = replace(star, cubes={})
    assert rows_of(reports.REPORTS[name](star)) == rows_of(reports.REPORTS[name](plain))


def test_reports_after_merges_read_only_what_changed(spark, sold, tmp_path):
    path = f"{tmp_path}/{FACT_TABLE}"
    star = build_star(sold, str(tmp_path), SPAN)
    fact = star.fact.drop("sale_year")
    changed = checkpointed(
        fact.where(F.col("transaction_id").rlike("^[0-3]")).dropDuplicates(["transaction_id"]).withColumns(
            {"net_sales": F.lit(7).cast("decimal(18,2)"), "cogs": F.lit(None).cast("decimal(18,2)")}
        )
    )
    for updates, policy in ((changed, "latest"), (changed, "keep_all"), (changed.limit(0), "latest")):
        merged = merge_fact(spark, path, updates, policy, sides=SPAN.sides)
    after = star_of(spark, merged, star.dims)
    assert set(after.cubes) == set(cubes.CUBES)
    plain = replace(after, cubes={})
    for name in ("monthly_sales_analysis", "discount_analysis"):
        assert rows_of(reports.REPORTS[name](after)) == rows_of(reports.REPORTS[name](plain)), name
    scanned = reports.monthly_sales_analysis(after)._jdf.queryExecution().optimizedPlan().toString()
    assert "sale_year" not in scanned and "transaction_date" not in scanned
    # A writer that does not keep the cubes up leaves a star without them.
    merged = merge_fact(spark, path, changed.limit(1), "latest")
    assert star_of(spark, merged, star.dims).cubes == {}


def test_cubes_made_for_a_session(star):
    bare = replace(star, cubes={})
    made = with_cubes(bare)
    for via, by in ((["dim_date"], ["year"]), (["dim_product"], ["product_name"]), (["dim_discount"], ["discount_key"])):
        for clean in (True, False):
            want = rollup(bare, via, by, clean=clean, rows="lines")
            assert rows_of(rollup(made, via, by, clean=clean, rows="lines")) == rows_of(want)
    where = {"dim_segment": F.col("segment_name") == "S"}
    args = (["dim_segment", "dim_date"], ["segment_name", "quarter"])
    assert rows_of(rollup(made, *args, where=where)) == rows_of(rollup(bare, *args, where=where))


def test_cubes_are_used_only_where_they_suffice(star):
    def cube(via, by, where=None):
        return cubes.covering(star.cubes, via, by, where or {}, star.dims)

    assert cube(["dim_date"], ["year", "month_name"]) == "calendar"
    assert cube(["dim_product", "dim_segment"], ["product_name"]) == "product"
    assert cube(["dim_date"], ["day_name"]) is None
    assert cube(["dim_date"], ["date_key"]) is None
    assert cube(["dim_date", "dim_product"], ["year", "product_name"]) is None
    assert cube(["dim_date"], ["year"], {"dim_date": F.col("is_weekend")}) is None


def test_sums_by_task_equal_sums_at_once(star, monkeypatch):
    bare = replace(star, cubes={})
    args = (["dim_product", "dim_date"], ["product_name", "year"])
    once = rows_of(rollup(bare, *args))
    monkeypatch.setattr(rollups, "MOST_LINES", 0)
    assert rows_of(rollup(bare, *args)) == once


def test_rollup_of_an_empty_fact(star):
    empty = replace(star, fact=star.fact.limit(0), repeats=star.repeats.limit(0), cubes={}, rows={})
    assert rollup(empty, ["dim_product"], ["product_name"]).count() == 0


@pytest.mark.parametrize("bins", [3, 1024])
def test_quantiles_of_odd_columns(spark, bins):
    rng = random.Random(1)
    rows = [
        (rng.gauss(0, 1), 10.0 ** rng.randrange(-8, 9) * rng.random(), 5.0 if rng.random() < 0.9 else rng.random(),
         None if rng.random() < 0.3 else rng.randrange(4), None, 7.0, float(i) if i else float("inf"))
        for i in range(3000)
    ]
    names = ["normal", "wide", "hot", "few", "none", "same", "endless"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" if n not in ("few",) else f"{n} int" for n in names)).repartition(6)
    ps = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    for limit in (1_000_000, 0):
        got = {(r[0], r[1]): r[2] for r in exact_quantiles(df, names, ps, limit, bins).collect()}
        for i, name in enumerate(names):
            values = [r[i] for r in rows if r[i] is not None]
            for p in ps:
                if values and np.isfinite(np.quantile(values, p)):
                    assert got[name, p] == pytest.approx(np.quantile(values, p), rel=1e-12), (name, p)
    assert not [k for k in got if k[0] == "none"]
    assert exact_quantiles(df.limit(0), names, ps).count() == 0


def test_bins_of_many_columns_are_compiled(spark):
    """The compiler of the JVM leaves methods beyond 8,000 bytes to its interpreter."""
    from salesloom.operators import quantiles

    names = [f"v{i}" for i in range(10)]
    df = spark.range(1000).select(*[(F.col("id") * (i + 1) % 997).cast("decimal(18,2)").alias(n) for i, n in enumerate(names)])
    brackets, _ = quantiles._brackets(df, names, (0.25, 0.5, 0.75))
    binned = quantiles._binned(df, brackets, quantiles.BINS)
    code = spark._jvm.PythonSQLUtils.explainString(binned._jdf.queryExecution(), "codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_quantiles_when_the_sketch_is_wrong(spark, monkeypatch):
    """Brackets that miss a quantile cost time, not the result."""
    from salesloom.operators import quantiles

    df = spark.range(2000).select(F.col("id").cast("double").alias("v"))
    real = quantiles._brackets

    def off(*args):
        found, wild = real(*args)
        return [replace(b, ranges=((100.0, 120.0), (1990.0, 1995.0))) for b in found], wild

    monkeypatch.setattr(quantiles, "_brackets", off)
    got = {r[1]: r[2] for r in exact_quantiles(df, ["v"], (0.05, 0.5, 0.999)).collect()}
    assert got == pytest.approx({0.05: 99.95, 0.5: 999.5, 0.999: 1997.001})


def test_days_in_all_formats(spark):
    texts = {
        "2014-03-05": date(2014, 3, 5), "3/5/2014": date(2014, 3, 5), "2014-03-05 23:59:58": date(2014, 3, 5),
        "2014/03/05": date(2014, 3, 5), "05-Mar-2014": date(2014, 3, 5), " 12/31/2014 ": date(2014, 12, 31),
        "31/12/2014": None, "": None, "soon": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", parse_day(F.col("t"))).collect()} == texts


def test_lost_digits(lines):
    raw = raw_text(lines(*[{"units_sold": i} for i in range(6)]))
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    odd = F.element_at(F.array(*[F.lit(t) for t in ("$1.5", "$12.345", "1" + "0" * 16, "1e30", "NaN", "$-")]), F.col("i"))
    df = raw.withColumn("i", F.trim("Units Sold").cast("double").cast("int") + 1).withColumn("Sales", odd)
    found = {r["column_name"]: (r["rounded"], r["too_large"]) for r in lost_digits(df).collect()}
    assert found["Sales"] == (1, 2) and found["Profit"] == (0, 0)

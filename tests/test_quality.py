from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.operators import profiling as pf
from salesloom.operators import quality as dq
from salesloom.plans.reports import all_reports
from salesloom.plans.warehouse import Settings, Star, build_star

SPAN = Settings(spine_start="2014-01-01", spine_end="2017-01-01", policy="keep_all")


@pytest.fixture(scope="module")
def good(lines, tmp_path_factory):
    staged = lines({}, {"product_name": "Desk"}, {"transaction_date": date(2015, 3, 3), "country_name": "Spain"})
    return build_star(staged, str(tmp_path_factory.mktemp("good")), SPAN)


def found(checks):
    return {(r["check"], r["table_name"], r["column_name"]): (r["violations"], r["status"]) for r in checks.collect()}


def test_a_clean_warehouse_passes(good):
    reports = all_reports(good)
    checks = dq.run_checks(good, reports)
    assert set(checks.columns) == set(dq.CHECK_COLUMNS)
    assert tuple(dq.verdict(checks).first()) == (True, 61, 0, 0)
    assert dq.declared_tests(good).count() == 36
    board = dq.data_quality_dashboard(good, reports)
    assert board.count() == 30
    assert {r["status"] for r in board.collect()} == {"Good", "Consistent"}


def test_planted_defects_are_found(good):
    extra = good.fact.limit(1).withColumns(
        {
            "product_key": F.lit(None).cast("bigint"),
            "segment_key": F.lit(99).cast("bigint"),
            "net_sales": F.lit(-1).cast("decimal(18,2)"),
            "has_missing_keys": F.lit(True),
        }
    )
    other = good.fact.limit(1).withColumns(
        {"transaction_id": F.lit(None).cast("string"), "units_sold": F.lit(0).cast("decimal(18,2)")}
    )
    star = Star(good.fact.unionByName(extra).unionByName(other), good.dims)
    checks = dq.run_checks(star, all_reports(good))
    got = found(checks)
    fact = dq.FACT_NAME
    assert got["not_null", fact, "product_key"] == (1, "fail")
    assert got["not_null", fact, "transaction_id"] == (1, "fail")
    assert got["unique", fact, "transaction_id"] == (1, "fail")
    assert got["relationships", fact, "segment_key"] == (1, "fail")
    assert got["relationships", fact, "product_key"] == (0, "pass")
    assert got["referential_integrity", fact, "product_key"] == (1, "fail")
    assert got["row_rule", fact, "negative_sales"] == (1, "warn")
    assert got["row_rule", fact, "units_sold_zero_with_sales"] == (1, "warn")
    assert got["row_rule", fact, "profit_margin_validation"] == (1, "warn")
    assert not dq.verdict(checks).first()["passed"]
    metrics = dq.fact_metrics(star.fact).first()
    assert metrics["row_count"] == 5 and metrics["null_key_count"] == 1
    # one repeated id and one row without an id
    assert metrics["duplicate_key_count"] == 2 and metrics["records_with_missing_keys"] == 1


def test_warnings_do_not_fail(good):
    checks = dq.row_rules(good.fact.withColumn("net_sales", -F.col("net_sales")))
    assert dq.verdict(checks).first()["passed"] and dq.verdict(checks).first()["warned"] >= 1


def test_empty_tables(good):
    empty = Star(good.fact.limit(0), {n: d.limit(0) for n, d in good.dims.items()})
    assert set(found(dq.non_empty({"a": empty.fact})).values()) == {(1, "fail")}
    assert dq.orphans(empty.fact, empty.dims).count() == 5
    assert set(found(dq.not_null(empty.fact, "f", ["profit"])).values()) == {(0, "pass")}


def test_reconciliation_tolerance(good):
    reports = all_reports(good)
    off = {**reports, "monthly_sales_analysis": reports["monthly_sales_analysis"].withColumn(
        "net_sales", F.col("net_sales") + F.when(F.col("year") == 2014, 1).otherwise(0))}
    got = found(dq.reconciled(good.fact, off))
    # a difference of exactly 1 passes the check and shows as inconsistent on the dashboard
    assert got["reconciliation", dq.FACT_NAME, "monthly_sales_totals_match_fact"] == (0, "pass")
    board = {r["metric_name"]: r["status"] for r in dq.data_quality_dashboard(good, off).collect()}
    assert board["monthly_sales_vs_fact"] == "Inconsistent" and board["segment_sales_vs_fact"] == "Consistent"


@pytest.mark.parametrize("n, expected", [(0, "Good"), (1, "Warning"), (4, "Warning"), (5, "Error")])
def test_share_status(spark, n, expected):
    df = spark.createDataFrame([(n, 100)], "n bigint, t bigint")
    assert df.select(dq.share_status(F.col("n"), F.col("t"), "0.05")).first()[0] == expected


def test_strict_calendar_counts(good):
    doubled = {**good.dims, "dim_date": good.dims["dim_date"].unionByName(good.dims["dim_date"])}

    def copies(strict):
        rows = dq.dimension_counts(doubled, strict).where("dimension_table = 'dim_date'")
        return rows.first()["duplicate_key_count"]

    assert copies(False) == 0 and copies(True) == 1096


def test_profiles(lines):
    df = lines({}, {}, {"profit": None, "discount_band": None}, {"manufacturing_price": 4, "country_name": "Spain"})
    assert pf.duplicate_rows(df).first()[0] == 1
    nulls = {r["column_name"]: r["null_count"] for r in pf.null_counts(df).collect()}
    assert nulls["profit"] == 1 and nulls["net_sales"] == 0
    top = {(r["column_name"], r["value"]): (r["n"], r["distinct_values"]) for r in pf.categorical_profile(df).collect()}
    assert top["country_name", "France"] == (3, 2) and top["discount_band", "Low"] == (3, 1)
    summary = {r["column_name"]: r for r in pf.describe(df, ["manufacturing_price", "profit"]).collect()}
    assert summary["manufacturing_price"]["p75"] == 3.25 and summary["profit"]["count"] == 3
    assert [tuple(r) for r in pf.repriced_products(df).collect()] == [("Lamp", 2)]
    assert pf.product_prices(df, "Lamp").count() == 2
    profile = {r["column_name"]: r for r in pf.table_profile(df).collect()}
    assert profile["profit"]["data_type"] == "decimal(18,2)" and profile["profit"]["table_rows"] == 4
    assert profile["profit"]["table_columns"] == 18

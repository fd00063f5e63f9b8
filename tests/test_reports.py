"""Reports on hand-made facts, and equality of their two counting routes."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.plans import adhoc, reports as rp
from salesloom.plans.rollup import rollup
from salesloom.plans.warehouse import Settings, Star, build_star, load_star

SPAN = Settings(spine_start="2014-01-01", spine_end="2017-01-01", policy="keep_all")


@pytest.fixture(scope="module")
def mixed(lines, tmp_path_factory):
    """2,000 lines: one product and one segment hold a third, ids repeat, some lines miss keys."""
    rnd = random.Random(3)
    changes = []
    for i in range(2000):
        units = rnd.choice([1, 2, 3])
        gross, off = rnd.randint(-5, 400) * units, rnd.choice([0, 0, 3, 7])
        cost = rnd.randint(0, 300)
        changes.append(
            {
                "product_name": "Lamp" if i % 3 == 0 else f"P{i % 11}",
                "segment_name": "Retail" if i % 3 == 0 else f"S{i % 4}",
                "country_name": rnd.choice(["France", "Germany", "Mexico", "Atlantis"]),
                "discount_band": rnd.choice(["None", "Low", "High", None]) if i % 7 == 0 else "Low",
                "units_sold": units,
                "manufacturing_price": rnd.choice([3, 4]),
                "gross_sales": gross,
                "discounts": off,
                "net_sales": gross - off,
                "cogs": cost,
                "profit": None if i % 5 == 0 else gross - off - cost,
                "transaction_date": date(2014, 1, 1) + timedelta(days=rnd.randint(0, 1100)),
            }
        )
    return build_star(lines(*changes), str(tmp_path_factory.mktemp("mixed")), SPAN)


def content(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", list(rp.REPORTS))
def test_both_counting_routes_agree(mixed, name):
    assert mixed.repeats.count() > 0
    plain = Star(mixed.fact, mixed.dims)
    assert content(rp.REPORTS[name](mixed)) == content(rp.REPORTS[name](plain))


def test_transactions_are_distinct_ids(mixed):
    total = rollup(mixed, ["dim_segment"], ["segment_name"]).agg(F.sum("transaction_count")).first()[0]
    clean = mixed.fact.where("not has_missing_keys")
    assert total == clean.select("transaction_id").distinct().count() < clean.count()


def test_reports_add_up_to_the_clean_fact(mixed):
    clean = mixed.fact.where("not has_missing_keys").agg(F.sum("net_sales"), F.sum("profit")).first()
    sales = {
        "monthly_sales_analysis": "net_sales",
        "product_profitability": "net_sales",
        "segment_performance": "net_sales",
        "geography_performance": "net_sales",
        "discount_analysis": "net_sales",
    }
    for name, column in sales.items():
        sums = rp.REPORTS[name](mixed).agg(F.sum(column), F.sum("total_profit")).first()
        assert tuple(sums) == tuple(clean), name


def test_large_amounts_take_the_wide_route(lines, tmp_path):
    huge = Decimal("9999999999999999.99")
    rows = [{"units_sold": u, "gross_sales": huge, "net_sales": huge, "discounts": 0} for u in range(1, 41)]
    star = build_star(lines(*rows), str(tmp_path), SPAN)
    assert not star.is_small("net_sales") and star.is_small("units_sold")
    assert rp.monthly_sales_analysis(star).first()["net_sales"] == huge * 40


def test_missing_ids_are_not_counted(mixed):
    from salesloom.operators.facts import repeated_ids

    holed = mixed.fact.withColumn("transaction_id", F.when(F.col("units_sold") != 2, F.col("transaction_id")))
    star = Star(holed, mixed.dims, repeated_ids(holed).drop("mixed"))
    exact = Star(holed, mixed.dims)
    assert content(rollup(star, ["dim_date"], ["year"])) == content(rollup(exact, ["dim_date"], ["year"]))


def test_calendar_joined_early_or_late(mixed, monkeypatch):
    from salesloom.plans import rollup as module

    by = ["year", "month_number", "segment_name"]
    late = content(rollup(mixed, ["dim_date", "dim_segment"], by))
    monkeypatch.setattr(module, "DAY_GROUPS", 0)
    assert content(rollup(mixed, ["dim_date", "dim_segment"], by)) == late


def test_distributed_ranks_in_reports(mixed):
    for report in (rp.product_profitability, rp.geography_performance):
        assert content(report(mixed)) == content(report(mixed, single_task_rows=0))


def test_month_gap_uses_the_previous_present_month(lines, tmp_path):
    star = build_star(
        lines({"net_sales": 100}, {"net_sales": 150, "transaction_date": date(2014, 4, 1)}), str(tmp_path), SPAN
    )
    first, second = rp.monthly_sales_analysis(star).collect()
    assert first["prev_month_net_sales"] is None and first["net_sales_mom_pct_change"] is None
    assert first["net_sales_mom_change"] == 100
    assert second["month_name"] == "April" and second["net_sales_mom_pct_change"] == 50.0


def test_zero_denominators(lines, tmp_path):
    star = build_star(
        lines({"net_sales": 0, "discounts": 0, "gross_sales": 0, "units_sold": 0, "profit": 5}), str(tmp_path), SPAN
    )
    product = rp.product_profitability(star).first()
    assert product["profit_margin_pct"] is None and product["profit_per_unit"] is None
    assert product["profit_category"] == "Loss Making"
    discount = rp.discount_analysis(star).first()
    assert discount["discount_effectiveness"] == "Ineffective"
    assert discount["roi_ratio"] == 0.0 and discount["profit_per_discount_dollar"] is None


def test_quarter_growth_restarts_and_year_growth_needs_the_year_before(lines, tmp_path):
    days = [date(2014, 2, 1), date(2014, 5, 1), date(2016, 2, 1)]
    sales = [100, 200, 300]
    star = build_star(
        lines(*[{"transaction_date": d, "net_sales": s} for d, s in zip(days, sales)]), str(tmp_path), SPAN
    )
    quarters = [(r["year"], r["quarter"], r["sales_qoq_growth_pct"]) for r in rp.segment_performance(star).collect()]
    assert quarters == [(2014, 1, None), (2014, 2, 100.0), (2016, 1, None)]
    years = [(r["year"], r["prev_year_sales"], r["sales_yoy_growth_pct"]) for r in rp.geography_performance(star).collect()]
    assert years == [(2014, None, None), (2016, None, None)]


def test_dashboard_order_and_first_period(lines, tmp_path):
    star = build_star(
        lines({}, {"transaction_date": date(2014, 5, 1), "net_sales": 130}, {"discount_band": "High"}),
        str(tmp_path),
        SPAN,
    )
    rows = rp.executive_dashboard(star).collect()
    assert [r["metric_category"] for r in rows] == [
        "Overall Performance", "Overall Performance", "Top Products", "Top Segments", "Top Countries",
        "Discount Effectiveness", "Discount Effectiveness",
    ]
    assert [r["time_period"] for r in rows[:2]] == ["2014-Q1", "2014-Q2"]
    assert rows[0]["revenue_pop_pct"] is None and rows[0]["margin_pop_delta"] == rows[0]["margin_pct"]
    assert rows[4]["time_period"] == "Europe" and rows[5]["volume"] is None


def test_year_filter_prunes_partitions(mixed):
    plan = adhoc.country_sales_in_year(mixed, 2015)._jdf.queryExecution().executedPlan().toString()
    assert "sale_year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_stored_star_loads(mixed, lines, tmp_path):
    build_star(lines({}, {}), str(tmp_path), SPAN)
    star = load_star(mixed.fact.sparkSession, str(tmp_path))
    assert rp.monthly_sales_analysis(star).first()["transaction_count"] == 1

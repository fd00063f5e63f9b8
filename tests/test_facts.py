from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.operators import facts, incremental as inc
from salesloom.plans.warehouse import Settings, build_star
from salesloom.schemas import FACT
from salesloom.sources.tables import save_by_year

SPAN = Settings(spine_start="2014-01-01", spine_end="2017-01-01", policy="keep_all")


def test_fact_rows(lines, tmp_path):
    staged = lines(
        {},
        {"product_name": "Desk", "profit": None},
        {"discount_band": None, "units_sold": 11},
        {"transaction_date": date(2035, 1, 1)},
        {"transaction_date": date(2016, 12, 31)},
        {"transaction_date": date(2017, 1, 1)},
    )
    star = build_star(staged, str(tmp_path), SPAN)
    rows = star.fact.drop("sale_year")
    assert [f.name for f in rows.schema] == [f.name for f in FACT]
    by_day = {(r["transaction_date"], r["product_key"], int(r["units_sold"])): r for r in rows.collect()}
    assert len(by_day) == 6
    good = by_day[(date(2014, 1, 1), 2, 10)]
    assert not good["has_missing_keys"] and good["date_key"] == 20140101
    desk = by_day[(date(2014, 1, 1), 1, 10)]
    assert desk["profit"] == Decimal("35.00")
    unbanded = by_day[(date(2014, 1, 1), 2, 11)]
    assert unbanded["discount_key"] is None and unbanded["has_missing_keys"]
    assert by_day[(date(2035, 1, 1), 2, 10)]["date_key"] is None
    assert by_day[(date(2016, 12, 31), 2, 10)]["date_key"] == 20161231
    assert by_day[(date(2017, 1, 1), 2, 10)]["has_missing_keys"]
    assert len({r["transaction_id"] for r in by_day.values()}) == 6


def test_facts_meet_the_current_version_only(lines, tmp_path):
    staged = lines({"manufacturing_price": 3}, {"manufacturing_price": 4, "transaction_date": date(2014, 2, 1)})
    star = build_star(staged, str(tmp_path), SPAN)
    assert star.dims["dim_product"].count() == 2
    assert {r["product_key"] for r in star.fact.collect()} == {2}


def test_lookup_without_broadcast_gives_the_same(lines, tmp_path):
    staged = lines({}, {"segment_name": None}, {"country_name": "Spain"})
    star = build_star(staged, str(tmp_path), SPAN)
    huge = {name: 10**9 for name in star.dims}
    ids = ["transaction_id", "segment_key", "geography_key", "product_key", "has_missing_keys"]
    a = facts.sales_fact(staged, star.dims, star.rows).select(*ids)
    b = facts.sales_fact(staged, star.dims, huge).select(*ids)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_dedupe_policies(lines, tmp_path):
    old, new = datetime(2020, 1, 1), datetime(2020, 1, 2)
    staged = lines(
        {"load_datetime": old, "net_sales": 1}, {"load_datetime": new, "net_sales": 2}, {"units_sold": 11}
    )
    star = build_star(staged, str(tmp_path / "a"), SPAN)
    assert star.fact.count() == 3 and star.repeats.count() == 1
    assert star.repeats.first()["surplus"] == 1
    latest = facts.deduplicate(star.fact, "latest")
    assert latest.columns == star.fact.columns and latest.count() == 2
    assert {int(r["net_sales"]) for r in latest.where("units_sold = 10").collect()} == {2}
    with pytest.raises(ValueError, match="1 repeated"):
        facts.deduplicate(star.fact, "error")
    with pytest.raises(ValueError, match="unknown policy"):
        facts.deduplicate(star.fact, "some")
    with pytest.raises(ValueError, match="1 repeated"):
        build_star(staged, str(tmp_path / "b"), Settings("2014-01-01", "2017-01-01"))


def test_ids_that_differ_in_a_key_are_marked(lines, tmp_path):
    # The joined text of both rows is the same: "a-b" + "c" and "a" + "b-c".
    staged = lines(
        {"product_name": "a-b", "segment_name": "c"}, {"product_name": "a", "segment_name": "b-c"}
    )
    star = build_star(staged, str(tmp_path), SPAN)
    assert star.fact.select("transaction_id").distinct().count() == 1
    assert star.repeats is None


def test_many_repeated_ids_are_not_looked_up(lines, tmp_path, rows_of, monkeypatch):
    """Rows move once, in the aggregate by id, and not once more for either side of a look-up."""
    from salesloom.operators import counting

    old, new = datetime(2020, 1, 1), datetime(2020, 1, 2)
    staged = lines(
        *[{"units_sold": u, "load_datetime": t, "net_sales": t.day} for u in range(9) for t in (old, new)], {"units_sold": 10}
    )
    star = build_star(staged, str(tmp_path / "a"), SPAN)
    holed = star.fact.withColumn("transaction_id", F.when(F.col("units_sold") != 2, F.col("transaction_id")))
    few = {policy: rows_of(facts.deduplicate(holed, policy)) for policy in ("latest", "keep_all")}
    surplus, values = rows_of(facts.repeated_ids(holed)), rows_of(counting.repeated_values(holed, ["transaction_id"]))
    monkeypatch.setattr(counting, "BROADCAST_ROWS", 0, raising=False)
    latest = facts.deduplicate(holed, "latest")
    assert rows_of(latest) == few["latest"] and latest.count() == 10
    assert {int(r["net_sales"]) for r in latest.where("units_sold < 9").collect()} == {2}
    assert "Join" not in latest._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(facts.deduplicate(holed, "keep_all")) == few["keep_all"]
    assert rows_of(facts.repeated_ids(holed)) == surplus
    assert rows_of(counting.repeated_values(holed, ["transaction_id"])) == values
    with pytest.raises(ValueError, match="9 repeated"):
        facts.deduplicate(star.fact, "error")


def test_repeated_ids_are_counted_without_a_sort(spark, rows_of):
    keys = "transaction_id string, date_key int, product_key long, segment_key long, geography_key long, discount_key long"
    fact = spark.createDataFrame(
        [
            ("same", 1, 1, 1, 1, None, True), ("same", 1, 1, 1, 1, None, True), ("same", 1, 1, 1, 1, None, True),
            ("other", 1, 1, 1, 1, 1, False), ("other", 1, 2, 1, 1, 1, False),
            ("holed", 1, 1, 1, 1, 1, True), ("holed", None, 1, 1, 1, 1, True),
            ("once", 1, 1, 1, 1, 1, False), (None, 1, 1, 1, 1, 1, False), (None, 1, 1, 1, 1, 1, False),
        ],
        f"{keys}, has_missing_keys boolean",
    )
    for large in (True, False):
        found = facts.repeated_ids(fact, large)
        assert rows_of(found) == sorted(
            [
                ("same", 1, 1, 1, 1, None, True, 2, False), ("other", 1, 1, 1, 1, 1, False, 1, True),
                ("holed", None, 1, 1, 1, 1, True, 1, True), (None, 1, 1, 1, 1, 1, False, 2, False),
            ],
            key=str,
        )
        assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def updates(star, **changes):
    return star.fact.drop("sale_year").withColumns(changes)


def test_upsert(spark, lines, tmp_path):
    days = [date(2014, 1, 1), date(2014, 6, 1), date(2015, 1, 1), date(2016, 1, 1)]
    star = build_star(lines(*[{"transaction_date": d} for d in days]), str(tmp_path / "s"), SPAN)
    path = str(tmp_path / "fact")
    save_by_year(star.fact, path)
    untouched = sorted(p.name for p in (tmp_path / "fact" / "sale_year=2016").iterdir())
    new = star.fact.drop("sale_year").where("date_key < 20150601").withColumn(
        "net_sales", F.lit(Decimal("99.00"))
    )
    for _ in range(2):  # a repeated run changes nothing
        out = inc.upsert(spark, path, new)
        assert {r["transaction_date"]: int(r["net_sales"]) for r in out.collect()} == {
            days[0]: 99, days[1]: 99, days[2]: 99, days[3]: 65,
        }
    assert sorted(p.name for p in (tmp_path / "fact" / "sale_year=2016").iterdir()) == untouched


def test_upsert_of_a_key_that_moves_to_another_year(spark, lines, tmp_path):
    star = build_star(
        lines({}, {"transaction_date": date(2015, 1, 1)}, {"transaction_date": date(2015, 2, 1)}),
        str(tmp_path / "s"),
        SPAN,
    )
    path = str(tmp_path / "fact")
    save_by_year(star.fact, path)
    moved = star.fact.drop("sale_year").where("date_key = 20140101").withColumn(
        "transaction_date", F.lit(date(2016, 5, 5))
    )
    out = inc.upsert(spark, path, moved, key_fixes_year=False)
    assert sorted(r["transaction_date"] for r in out.collect()) == [
        date(2015, 1, 1), date(2015, 2, 1), date(2016, 5, 5),
    ]
    assert out.select("transaction_id").distinct().count() == 3
    assert not (tmp_path / "fact" / "sale_year=2014").exists()


def test_upsert_rejects_repeated_keys_and_keeps_the_table(spark, lines, tmp_path):
    star = build_star(lines({}), str(tmp_path / "s"), SPAN)
    path = str(tmp_path / "fact")
    save_by_year(star.fact, path)
    twice = star.fact.drop("sale_year")
    with pytest.raises(ValueError):
        inc.upsert(spark, path, twice.unionByName(twice))
    assert spark.read.parquet(path).count() == 1
    assert inc.upsert(spark, path, twice.limit(0)).count() == 1


def test_upsert_writes_the_rows_once_and_leaves_nothing(spark, lines, tmp_path, monkeypatch):
    from salesloom.session import checkpoint_root
    from salesloom.sources import storage

    star = build_star(lines({}, {"product_name": "Vase"}), str(tmp_path / "s"), SPAN)
    path, fact, writes = str(tmp_path / "fact"), star.fact.drop("sale_year"), []
    before = set(storage.names_in(spark, checkpoint_root(spark)))
    save_by_year(star.fact, path)
    writer = inc.table_writer

    def counted(df, *args):
        writes.append(df)
        return writer(df, *args)

    monkeypatch.setattr(inc, "table_writer", counted)
    dear = fact.withColumn("net_sales", F.lit(Decimal("99.00")))
    # The updates, the rows picked of those that repeat, the merged rows: these go into the table without a copy between.
    for changes, needed in ((dear, 2), (fact.unionByName(dear), 3)):
        writes.clear()
        out = inc.upsert(spark, path, changes, policy="latest")
        assert [int(r["net_sales"]) for r in out.collect()] == [99, 99]
        assert len(writes) == needed
    left = set(storage.names_in(spark, checkpoint_root(spark))) - before
    assert not [name for name in left if name.startswith("upsert")]


def test_upsert_of_undated_rows(spark, lines, tmp_path):
    star = build_star(lines({}, {"transaction_date": None}), str(tmp_path / "s"), SPAN)
    path = str(tmp_path / "fact")
    save_by_year(star.fact, path)
    out = inc.upsert(spark, path, star.fact.drop("sale_year"))
    assert out.count() == 2 and out.where("transaction_date is null").count() == 1


def test_incremental_start(lines, tmp_path):
    star = build_star(lines({}), str(tmp_path), SPAN)
    assert inc.incremental_start(star.fact) == "2020-01-01"
    assert inc.incremental_start(None, date(2021, 5, 2)) == "2021-05-01"
    assert inc.incremental_start(star.fact.limit(0), date(2021, 5, 2)) == "2021-05-01"


def test_rows_after_the_start(lines):
    staged = lines({"load_datetime": datetime(2020, 1, 1, 23)}, {"load_datetime": datetime(2020, 1, 2)})
    assert inc.loaded_after(staged).count() == 2
    assert inc.loaded_after(staged, "2020-01-01").count() == 1
    assert inc.loaded_after(staged, "2020-01-02", inclusive=True).count() == 1


def test_schema_sync(spark):
    df = spark.createDataFrame([(1, "x")], "a int, gone string")
    schema = spark.createDataFrame([], "a bigint, b string").schema
    out = inc.sync_columns(df, schema)
    assert out.schema.simpleString() == "struct<a:bigint,b:string>" and tuple(out.first()) == (1, None)

"""Loads that can be repeated, tables by version, merges by file: also after a run that was cut off."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salesloom.operators import merging
from salesloom.operators.facts import deduplicate
from salesloom.operators.merging import merge_fact, publish_fact, surplus_of
from salesloom.plans import reports, warehouse
from salesloom.plans.rollup import rollup
from salesloom.plans.warehouse import FACT_TABLE, Settings, load_star, run_warehouse, star_of
from salesloom.registry.texts import raw_text
from salesloom.sources import snapshots, storage
from salesloom.sources.files import write_csv
from salesloom.sources.loads import land_file, landed, ledger
from salesloom.sources.tables import read_table

SPAN = ("2014-01-01", "2018-01-01")


def batch(lines, start, products, copies=1):
    days = [date(2014, 1, 1) + timedelta(days=60 * i + start) for i in range(18)]
    return lines(
        *[
            {"transaction_date": d, "product_name": p, "segment_name": f"S{p}", "units_sold": i + 1 + ord(p),
             "net_sales": 65 + ord(p) + 10 * copy, "profit": 35 + ord(p)}
            for i, d in enumerate(days)
            for p in products
            for copy in range(copies)
        ]
    )


@pytest.fixture(scope="module")
def files(lines, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    first, second = batch(lines, 0, ["B", "D"]), batch(lines, 3, ["A", "B", "C"])
    tables = {"first": first, "second": second, "both": first.unionByName(second)}
    doubled = {"first2": batch(lines, 0, ["B", "D"], 2), "second2": batch(lines, 3, ["A", "B"], 2)}
    doubled["both2"] = doubled["first2"].unionByName(doubled["second2"])
    for name, df in {**tables, **doubled}.items():
        write_csv(raw_text(df), str(folder / name))
    return folder


@pytest.fixture(autouse=True)
def few_reports(monkeypatch):
    """Two reports are enough to see what a run does."""
    monkeypatch.setattr(reports, "REPORTS", {n: reports.REPORTS[n] for n in ("monthly_sales_analysis", "discount_analysis")})


def content(spark, root):
    """The fact and the reports without keys and load times."""
    star = load_star(spark, f"{root}/staging")
    found = {"fact": star.fact.drop("product_key", "segment_key", "geography_key", "discount_key", "load_date")}
    for name in reports.REPORTS:
        table = read_table(spark, f"{root}/analytics/{name}")
        found[name] = table.drop("product_key", "segment_key", "geography_key", "discount_key")
    return {name: sorted(map(str, df.collect())) for name, df in found.items()}


# Versions of tables


def test_a_failed_rebuild_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = snapshots.publish(spark.range(3), path)
    broken = spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        snapshots.publish(broken, path)
    # Cut off after the files are written and before the pointer is.
    monkeypatch.setattr(storage, "write_text_once", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        snapshots.publish(spark.range(9), path)
    monkeypatch.undo()
    assert old.count() == read_table(spark, path).count() == 3
    assert len(snapshots.clear_unfinished(spark, path)) == 2
    assert snapshots.clear_unfinished(spark, path) == []
    assert read_table(spark, path).count() == 3


def test_readers_keep_their_version_and_old_ones_are_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    first = snapshots.publish(spark.range(1), path)
    second = snapshots.publish(spark.range(2), path)
    assert (first.count(), second.count()) == (1, 2)
    third = snapshots.publish(read_table(spark, path).unionByName(read_table(spark, path)), path)
    assert (second.count(), third.count()) == (2, 4)
    assert snapshots.versions(spark, path) == [2, 3]
    assert len(storage.names_in(spark, f"{path}/data")) == 2
    assert snapshots.opened(spark, path, 1) is None
    assert snapshots.opened(spark, path, 2).read(spark).count() == 2


def test_two_writers_cannot_make_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.publish(spark.range(1), path)
    part = snapshots.write_parts(spark.range(5), path)
    snapshots.publish(spark.range(2), path)
    with pytest.raises(FileExistsError):
        snapshots.commit(spark, path, spark.range(5).schema, [part], after=1)
    assert read_table(spark, path).count() == 2


def test_versions_keep_descriptions_empty_tables_and_null_partitions(spark, lines, tmp_path):
    path = str(tmp_path / "t")
    made = snapshots.publish(lines({}, {"year": None, "transaction_date": None}), path, ["year"])
    assert sorted(r["year"] is None for r in made.collect()) == [False, True]
    from salesloom.schemas import column_comments

    assert column_comments(read_table(spark, path))["net_sales"] == "gross sales less discounts"
    assert snapshots.publish(lines({}).limit(0), path, ["year"]).count() == 0
    assert read_table(spark, path).columns == made.columns


# Loads


def test_a_repeated_load_replaces_itself(spark, files, tmp_path):
    path = str(tmp_path / "landed")
    one = land_file(spark, path, str(files / "first"))
    two = land_file(spark, path, str(files / "second"))
    assert (one.rows, two.rows) == (36, 54) and one.loaded_at < two.loaded_at
    again = land_file(spark, path, str(files / "first"))
    assert again.key == one.key and again.loaded_at > two.loaded_at
    assert [load.loaded_at for load in ledger(spark, path)] == [two.loaded_at, again.loaded_at]
    assert landed(spark, path).count() == 90
    assert landed(spark, path, [two]).count() == 54
    assert landed(spark, path).select("load_datetime").distinct().count() == 2


def test_a_changed_file_is_a_load_of_its_own(spark, files, lines, tmp_path):
    path, source = str(tmp_path / "landed"), str(tmp_path / "in")
    write_csv(raw_text(batch(lines, 0, ["B"])), source)
    one = land_file(spark, path, source)
    write_csv(raw_text(batch(lines, 0, ["B"], 2)), source)
    two = land_file(spark, path, source)
    assert one.key != two.key and landed(spark, path).count() == one.rows + two.rows


def test_the_content_hash_sees_every_value_and_no_order(spark, lines, tmp_path):
    def digest(name, frame):
        write_csv(raw_text(frame), str(tmp_path / name))
        return land_file(spark, str(tmp_path / f"{name}-landed"), str(tmp_path / name)).digest

    base = lines({}, {"units_sold": 4}, {"units_sold": 5})
    assert digest("a", base) == digest("b", base.orderBy(F.desc("units_sold")).coalesce(1))
    assert digest("c", lines({}, {"units_sold": 4}, {"units_sold": 6})) != digest("d", base)
    # Pairs of equal rows leave a trace.
    assert digest("e", lines({}, {})) != digest("f", lines({"units_sold": 9}, {"units_sold": 9}))
    assert digest("g", base.limit(0)) == "0" * 32


@pytest.mark.parametrize("policy", ["keep_all", "latest"])
def test_repeated_runs_equal_one_load(spark, files, tmp_path, policy):
    settings = Settings(*SPAN, policy=policy, buckets=2)
    repeated, single = str(tmp_path / "repeated"), str(tmp_path / "single")
    for name in ("first2", "second2", "first2"):
        run_warehouse(spark, repeated, str(files / name), settings=settings, skip_checks=True)
    run_warehouse(spark, single, str(files / "both2"), settings=settings, skip_checks=True)
    assert content(spark, repeated) == content(spark, single)
    # Nothing new: the fact keeps all its files.
    run_warehouse(spark, repeated, skip_load=True, settings=settings, skip_checks=True)
    assert snapshots.opened(spark, f"{repeated}/staging/{FACT_TABLE}").stamps["rewritten"] == 0
    assert load_star(spark, f"{repeated}/staging").fact.count() == load_star(spark, f"{single}/staging").fact.count()


def test_a_run_cut_off_after_any_step_can_be_repeated(spark, files, tmp_path, monkeypatch):
    settings = Settings(*SPAN)
    cut, whole = str(tmp_path / "cut"), str(tmp_path / "whole")

    def fail(*_, **__):
        raise RuntimeError("cut off")

    def run(root, name):
        return run_warehouse(spark, root, str(files / name), settings=settings, skip_checks=True)

    run(whole, "first")
    run(whole, "second")
    run(cut, "first")
    for target, name in ((warehouse, "build_dimensions"), (warehouse, "merge_fact"), (warehouse, "side_by_side")):
        with monkeypatch.context() as patch:
            patch.setattr(target, name, fail)
            with pytest.raises(RuntimeError):
                run(cut, "second")
    run(cut, "second")
    assert content(spark, cut) == content(spark, whole)
    assert len(ledger(spark, f"{cut}/raw_financials")) == 2


def test_an_incremental_run_parses_new_loads_only(spark, files, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "r"), []
    real = warehouse.stage

    def counted(raw):
        seen.append(raw.count())
        return real(raw)

    monkeypatch.setattr(warehouse, "stage", counted)
    for name in ("first", "second"):
        run_warehouse(spark, root, str(files / name), settings=Settings(*SPAN), skip_checks=True)
    assert seen == [36, 54]


def test_late_sales_move_a_version_back_and_keep_keys(spark, lines, tmp_path):
    root, settings = str(tmp_path / "r"), Settings(*SPAN)
    first = lines({"manufacturing_price": 3}, {"manufacturing_price": 4, "transaction_date": date(2014, 6, 1)})
    second = lines(
        {"manufacturing_price": 4, "transaction_date": date(2014, 3, 1)},
        {"product_name": "Vase", "country_name": "Chile", "transaction_date": date(2014, 3, 1)},
    )
    for name, frame in (("one", first), ("two", second)):
        write_csv(raw_text(frame), f"{tmp_path}/{name}")
        run_warehouse(spark, root, f"{tmp_path}/{name}", settings=settings, skip_checks=True)
    products = {
        (r["product_name"], int(r["manufacturing_price"])): r for r in load_star(spark, f"{root}/staging").dims["dim_product"].collect()
    }
    assert [products["Lamp", p]["product_key"] for p in (3, 4)] == [1, 2] and products["Vase", 3]["product_key"] == 3
    assert products["Lamp", 4]["effective_date"] == date(2014, 3, 1)
    assert products["Lamp", 3]["end_date"] == date(2014, 2, 28)
    assert load_star(spark, f"{root}/staging").fact.where("has_missing_keys").count() == 0


# Merges by file


@pytest.fixture(scope="module")
def star(spark, files, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    run_warehouse(spark, root, str(files / "both2"), settings=Settings(*SPAN, policy="keep_all"), skip_checks=True)
    return load_star(spark, f"{root}/staging")


def counts_agree(spark, star, table):
    after = star_of(spark, table, star.dims)
    assert after.repeats is not None
    exact = star_of(spark, snapshots.Snapshot(table.path, table.version, table.schema, table.parts), star.dims)
    assert exact.repeats is None
    by = ["year", "month_number"]
    want = sorted(map(tuple, rollup(exact, ["dim_date"], by, totals=["net_sales"]).collect()))
    assert sorted(map(tuple, rollup(after, ["dim_date"], by, totals=["net_sales"]).collect())) == want


def test_only_files_with_a_changed_id_are_rewritten(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    base = publish_fact(star.fact.drop("sale_year"), path, buckets=4)
    files = base.files(spark)
    one = star.fact.drop("sale_year").orderBy("transaction_id").limit(1).withColumn("net_sales", F.lit(999).cast("decimal(18,2)"))
    merged = merge_fact(spark, path, one, policy="latest")
    assert merged.stamps["rewritten"] == 1
    assert len(set(files) - set(merged.parts)) == 1
    id = one.first()["transaction_id"]
    assert [int(r["net_sales"]) for r in merged.read(spark).where(F.col("transaction_id") == id).collect()] == [999]
    assert merged.read(spark).count() == star.fact.count() - 1
    counts_agree(spark, star, merged)
    # The version before is whole as long as it is kept.
    assert snapshots.opened(spark, path, 1).read(spark).count() == star.fact.count()
    new = one.withColumns({"transaction_id": F.lit("new"), "transaction_date": F.lit("2016-05-05").cast("date"), "date_key": F.lit(20160505)})
    added = merge_fact(spark, path, new, policy="latest")
    assert added.stamps["rewritten"] == 0 and added.read(spark).count() == star.fact.count()
    counts_agree(spark, star, added)


def test_kept_rows_of_large_files_are_not_shuffled(spark, star, tmp_path, monkeypatch):
    path, fact = str(tmp_path / "fact"), star.fact.drop("sale_year")
    publish_fact(fact, path)
    rows, plans, write = fact.count(), [], snapshots.write_parts

    def written(df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **more)

    monkeypatch.setattr(snapshots, "write_parts", written)
    one = fact.where("transaction_id is not null").orderBy("transaction_id").limit(1)
    first = merge_fact(spark, path, one.withColumn("net_sales", F.lit(5).cast("decimal(18,2)")), "latest")
    # The new row is grouped by folder; what stays of its file is written where it is read.
    assert ["RebalancePartitions" in plan for plan in plans] == [True, False]
    assert first.stamps["rewritten"] == 1 and len(first.parts) == len(snapshots.opened(spark, path, 1).files(spark)) + 1
    counts_agree(spark, star, first)
    # The small file of that merge is put together with the rows of the next.
    second = merge_fact(spark, path, one.withColumn("net_sales", F.lit(6).cast("decimal(18,2)")), "latest")
    assert len(second.parts) == len(first.parts) and second.read(spark).count() == first.read(spark).count() <= rows
    id = one.first()["transaction_id"]
    assert [int(r["net_sales"]) for r in second.read(spark).where(F.col("transaction_id") == id).collect()] == [6]
    counts_agree(spark, star, second)


def test_a_merge_makes_its_rows_once(spark, star, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    fact = star.fact.drop("sale_year")
    publish_fact(fact, path, buckets=2)
    made = spark.sparkContext.accumulator(0)

    def counted(rows, policy):
        def seen(batches):
            for batch in batches:
                made.add(len(batch))
                yield batch

        picked = deduplicate(rows, policy)
        return picked.mapInArrow(seen, picked.schema)

    monkeypatch.setattr(merging, "deduplicate", counted)
    merged = merge_fact(spark, path, fact.unionByName(fact.withColumn("profit", F.lit(1).cast("decimal(18,2)"))), "latest")
    assert made.value == merged.read(spark).count() == fact.select("transaction_id").distinct().count()


@pytest.mark.parametrize("buckets", [3])
def test_many_merges_keep_the_surplus_right(spark, star, tmp_path, buckets):
    path = str(tmp_path / "fact")
    fact = star.fact.drop("sale_year")
    publish_fact(fact, path, buckets)
    for n, digits in enumerate(("[01]", "[2]", "[3]", "[45]", "[6]", "[7]", "[8]", "[9]")):
        policy = "keep_all" if n in (2, 4, 7) else "latest"
        merged = merge_fact(spark, path, fact.where(F.col("transaction_id").rlike(f"^{digits}")), policy)
    deltas = merged.stamps["sides"]["parts"]["surplus"]
    assert len(deltas) < 8 and set(storage.names_in(spark, f"{path}/_sides/surplus")) >= set(deltas)
    counts_agree(spark, star, merged)
    want = deduplicate(fact.where(F.col("transaction_id").rlike("^[0124578]")), "latest").count()
    assert merged.read(spark).where(F.col("transaction_id").rlike("^[0124578]")).count() == want


def test_surplus_of_another_version_is_not_used(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    base = publish_fact(star.fact.drop("sale_year"), path)
    assert surplus_of(spark, base) is not None
    part = snapshots.write_parts(star.fact.limit(7), path, ["sale_year"])
    other = snapshots.commit(spark, path, base.schema, [part], base.stamps)
    assert surplus_of(spark, other) is None
    # A merge into it keeps the stamp of the old version, and the count stays exact.
    merged = merge_fact(spark, path, star.fact.drop("sale_year").limit(1), policy="latest")
    assert surplus_of(spark, merged) is None
    after = star_of(spark, merged, star.dims)
    counted = rollup(after, ["dim_date"], ["year"], totals=[]).agg(F.sum("transaction_count")).first()[0]
    assert counted == merged.read(spark).select("transaction_id").distinct().count()


def test_copies_that_differ_in_a_key_are_counted_exactly(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    fact = star.fact.drop("sale_year")
    publish_fact(fact, path, buckets=2)
    id = fact.first()["transaction_id"]
    mixed = fact.where(F.col("transaction_id") == id).withColumn("segment_key", F.monotonically_increasing_id() + 100)
    merged = merge_fact(spark, path, mixed, "keep_all")
    assert surplus_of(spark, merged) is None
    mended = merge_fact(spark, path, fact.where(F.col("transaction_id") == id).limit(1), "latest")
    assert surplus_of(spark, mended) is not None
    counts_agree(spark, star, mended)


def test_rows_without_id_and_removed_loads(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    loads = ["2020-01-01 00:00:00", "2020-01-02 00:00:00"]
    fact = star.fact.drop("sale_year")
    named = fact.withColumn("load_date", F.lit(loads[0]).cast("timestamp"))
    nameless = fact.limit(4).withColumns(
        {"transaction_id": F.lit(None).cast("string"), "load_date": F.lit(loads[1]).cast("timestamp")}
    )
    publish_fact(named.unionByName(nameless), path, buckets=2)
    merged = merge_fact(spark, path, nameless.limit(0), "keep_all", removed_loads=[loads[1]])
    assert merged.read(spark).count() == fact.count()
    counts_agree(spark, star, merged)
    merged = merge_fact(spark, path, nameless, "keep_all", removed_loads=[loads[0]])
    assert merged.read(spark).count() == 4
    counts_agree(spark, star, merged)

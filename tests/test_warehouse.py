"""The whole run: text file in, reports and verdict out; slices equal a full refresh."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salesloom.plans.reports import REPORTS
from salesloom.plans.warehouse import Settings, load_star, run_warehouse
from salesloom.registry.texts import raw_text
from salesloom.sources.files import write_csv
from salesloom.sources.tables import read_table
from salesloom.streaming.incremental_stream import merge_files

SPAN = Settings(spine_start="2014-01-01", spine_end="2017-01-01")


def batch(lines, start, products):
    days = [date(2014, 1, 1) + timedelta(days=40 * i + start) for i in range(20)]
    return lines(
        *[
            {
                "transaction_date": d,
                "product_name": p,
                "segment_name": f"S{p}",
                "discounts": i % 3,
                "units_sold": i + 1 + ord(p),
                "net_sales": 65 + ord(p),
                "profit": 35 + ord(p),
            }
            for i, d in enumerate(days)
            for p in products
        ]
    )


@pytest.fixture(scope="module")
def files(lines, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    first, second = batch(lines, 0, ["B", "D"]), batch(lines, 3, ["A", "B", "C"])
    for name, df in {"first": first, "second": second, "both": first.unionByName(second)}.items():
        write_csv(raw_text(df), str(folder / name))
    return folder


def report_rows(spark, root, name):
    rows = read_table(spark, f"{root}/analytics/{name}")
    return sorted(map(str, rows.drop("product_key", "segment_key", "geography_key", "discount_key").collect()))


def test_slices_equal_one_full_load(spark, files, tmp_path):
    sliced, full = str(tmp_path / "sliced"), str(tmp_path / "full")
    one = run_warehouse(spark, sliced, str(files / "first"), settings=SPAN)
    assert one.passed and one.incremental_start is None
    before = load_star(spark, f"{sliced}/staging").dims["dim_segment"].select("segment_name", "segment_key").collect()
    two = run_warehouse(spark, sliced, str(files / "second"), settings=SPAN)
    assert two.passed and two.incremental_start is not None
    run_warehouse(spark, full, str(files / "both"), full_refresh=True, settings=SPAN)
    star = load_star(spark, f"{sliced}/staging")
    after = {r["segment_name"]: r["segment_key"] for r in star.dims["dim_segment"].collect()}
    assert all(after[r["segment_name"]] == r["segment_key"] for r in before) and len(after) == 4
    assert star.fact.count() == 100
    for name in REPORTS:
        assert report_rows(spark, sliced, name) == report_rows(spark, full, name), name


def test_same_file_again_changes_nothing(spark, files, tmp_path):
    root = str(tmp_path)
    run_warehouse(spark, root, str(files / "first"), settings=SPAN)
    path = f"{root}/staging/fact_financial_transactions"
    ids = sorted(r[0] for r in read_table(spark, path).select("transaction_id").collect())
    again = run_warehouse(
        spark, root, str(files / "first"), start="2000-01-01", skip_checks=True,
        settings=Settings("2014-01-01", "2017-01-01", policy="latest"),
    )
    assert again.checks is None
    assert sorted(r[0] for r in read_table(spark, path).select("transaction_id").collect()) == ids


def test_skip_load_and_missing_file(spark, files, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        run_warehouse(spark, root, str(tmp_path / "absent"), settings=SPAN)
    run_warehouse(spark, root, str(files / "first"), settings=SPAN)
    rerun = run_warehouse(spark, root, skip_load=True, full_refresh=True, settings=SPAN)
    assert "load" not in rerun.steps and rerun.passed


def test_undiscounted_lines_get_their_profit(spark, lines, tmp_path):
    write_csv(raw_text(lines({"discount_band": "None", "profit": None})), str(tmp_path / "raw"))
    root = str(tmp_path / "w")
    run_warehouse(spark, root, str(tmp_path / "raw"), settings=SPAN)
    row = load_star(spark, f"{root}/staging").fact.first()
    assert int(row["profit"]) == 35 and not row["has_missing_keys"]


def test_stream_of_files_equals_batch(spark, files, tmp_path):
    root = str(tmp_path / "full")
    run_warehouse(spark, root, str(files / "both"), settings=SPAN)
    star = load_star(spark, f"{root}/staging")
    folder, path, marks = tmp_path / "arriving", str(tmp_path / "fact"), str(tmp_path / "marks")
    columns = ["transaction_id", "date_key", "product_key", "net_sales"]

    def arrive(name):
        import shutil

        folder.mkdir(exist_ok=True)
        for i, part in enumerate(sorted((files / name).glob("part-*"))):
            shutil.copy(part, folder / f"{name}-{i}.csv")
        merge_files(spark, str(folder), path, star.dims, marks).awaitTermination()
        return spark.read.parquet(path)

    first = arrive("first").count()
    assert first == 40
    assert arrive("first").count() == 40  # the same names are not read twice
    total = arrive("second")
    assert sorted(map(str, total.select(*columns).collect())) == sorted(map(str, star.fact.select(*columns).collect()))


def test_growth_by_category_and_regions(spark, files, tmp_path):
    from salesloom.plans import adhoc

    root = str(tmp_path)
    run_warehouse(spark, root, str(files / "both"), settings=SPAN, skip_checks=True)
    star = load_star(spark, f"{root}/staging")
    categories = spark.createDataFrame([("A", "x"), ("B", "x")], "product_name string, product_category string")
    growth = adhoc.category_growth(star, categories)
    assert {r["category"] for r in growth.collect()} == {"x", "Unknown"}
    assert adhoc.declining_regions(star).where(F.col("profit_change") >= 0).count() == 0

"""Streams: windows with late and repeated rows, members that arrive later, batches that come again."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from salesloom.operators.staging import strip_headers
from salesloom.plans.warehouse import FACT_TABLE, Settings, load_star
from salesloom.registry.texts import raw_text
from salesloom.sources import snapshots
from salesloom.sources.files import write_csv
from salesloom.streaming.sales_rollup import append_once, late_rows, roll_up, windowed_totals
from salesloom.streaming.warehouse_stream import merge_batch, stream_files

SALES = "sale string, shop string, amount decimal(18,2), at timestamp"
START = datetime(2024, 1, 1)


def hours(n):
    return START + timedelta(hours=n)


def test_late_and_repeated_rows(spark, tmp_path):
    from decimal import Decimal

    def sale(name, hour, amount=1, shop="x"):
        return (name, shop, Decimal(amount), hours(hour))

    batches = [
        [sale("a", 0), sale("b", 1), sale("c", 5), sale("c", 5), sale("n", 5, shop=None)],
        [sale("b", 1), sale("d", 4, 7), sale("e", 9, shop="y")],  # b again; d is late within bounds
        [sale("f", 30), sale("f", 30)],
        [sale("g", 2), sale("h", 31), sale("i", 60)],  # g is too late
        [sale("j", 100)],
    ]
    source, path, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    source.mkdir()

    def run():
        stream = spark.readStream.schema(SALES).option("maxFilesPerTrigger", 1).parquet(str(source))
        totals = windowed_totals(stream, "at", "sale", ["shop"], ["amount"], "3 hours", "6 hours")
        query = roll_up(totals, path, marks)
        query.awaitTermination()
        return query

    late = 0
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SALES).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        shutil.copy(next((tmp_path / f"part{i}").glob("part-*")), source / f"{i}.parquet")
        late += late_rows(run())
    assert late == 1

    def rows_of(df):
        return sorted(map(str, df.select("window_start", "window_end", "shop", "sales", "amount").collect()))

    counted = spark.createDataFrame([r for rows in batches for r in rows if r[0] != "g"], SALES)
    batch = windowed_totals(counted, "at", "sale", ["shop"], ["amount"], "3 hours", "6 hours")
    stored = snapshots.opened(spark, path)
    # Windows are stored once the newest row is 6 hours past their end: the last one is open.
    assert rows_of(stored.read(spark)) == rows_of(batch.where(F.col("window_end") <= F.lit(hours(94))))
    assert stored.read(spark).count() == 6
    # A restart without new files adds nothing.
    run()
    assert rows_of(snapshots.opened(spark, path).read(spark)) == rows_of(stored.read(spark))
    # Nor does a batch that is handed over again.
    append_once(path, "rollup")(stored.read(spark), 0)
    assert snapshots.opened(spark, path).read(spark).count() == 6


@pytest.fixture
def arriving(spark, lines, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()

    def arrive(name, *changes):
        write_csv(raw_text(lines(*changes)), str(tmp_path / name))
        for i, part in enumerate(sorted((tmp_path / name).glob("part-*"))):
            shutil.copy(part, folder / f"{name}-{i}.csv")

    return folder, arrive


def arrived(staged):
    """Lines as a batch of the file stream has them."""
    return strip_headers(raw_text(staged))


SETTINGS = Settings("2014-01-01", "2016-01-01", policy="latest", buckets=2)


def test_new_members_in_a_later_file(spark, arriving, tmp_path):
    folder, arrive = arriving
    path, marks = str(tmp_path / "star"), str(tmp_path / "marks")

    def run():
        stream_files(spark, str(folder), path, marks, SETTINGS).awaitTermination()
        return load_star(spark, path)

    arrive("one", {}, {"units_sold": 11, "net_sales": 70})
    star = run()
    assert star.fact.count() == 2 and star.dims["dim_geography"].count() == 1
    version = snapshots.opened(spark, f"{path}/{FACT_TABLE}").version
    run()  # no new file
    assert snapshots.opened(spark, f"{path}/{FACT_TABLE}").version == version
    arrive("two", {"country_name": "Chile", "product_name": "Vase"}, {"units_sold": 11, "net_sales": 99}, {"discount_band": "Odd"})
    star = run()
    assert star.fact.where("has_missing_keys").count() == 0
    assert {r["country_name"]: r["geography_key"] for r in star.dims["dim_geography"].collect()} == {"France": 1, "Chile": 2}
    assert star.dims["dim_product"].count() == 2
    assert sorted(int(r["net_sales"]) for r in star.fact.collect()) == [65, 65, 65, 99]
    assert star.repeats is not None


def test_a_batch_counts_once(spark, lines, tmp_path):
    path = str(tmp_path / "star")
    keep_all = Settings("2014-01-01", "2016-01-01", policy="keep_all")
    raw = arrived(lines({}, {"units_sold": 2}))
    assert merge_batch(raw, 0, path, keep_all, "s")
    before = snapshots.opened(spark, f"{path}/{FACT_TABLE}")
    assert not merge_batch(raw, 0, path, keep_all, "s")
    assert snapshots.opened(spark, f"{path}/{FACT_TABLE}").version == before.version
    assert merge_batch(arrived(lines({"units_sold": 3})), 1, path, keep_all, "s")
    assert merge_batch(arrived(lines({"units_sold": 4})), 0, path, keep_all, "another")
    after = snapshots.opened(spark, f"{path}/{FACT_TABLE}")
    assert after.stamps["batches"] == {"s": 1, "another": 0}
    assert after.read(spark).count() == 4


def test_a_batch_cut_off_before_the_fact_is_merged_later(spark, lines, tmp_path, monkeypatch):
    from salesloom.streaming import warehouse_stream

    path = str(tmp_path / "star")
    assert merge_batch(arrived(lines({})), 0, path, SETTINGS, "s")
    new = arrived(lines({"country_name": "Chile", "units_sold": 5}))
    with monkeypatch.context() as patch:
        patch.setattr(warehouse_stream, "merge_fact", lambda *_, **__: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            merge_batch(new, 1, path, SETTINGS, "s")
    # The member is there already, the line is not.
    assert load_star(spark, path).dims["dim_geography"].count() == 2 and load_star(spark, path).fact.count() == 1
    assert merge_batch(new, 1, path, SETTINGS, "s")
    star = load_star(spark, path)
    assert star.fact.count() == 2 and star.dims["dim_geography"].count() == 2
    assert star.fact.where("has_missing_keys").count() == 0

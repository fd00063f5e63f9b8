"""Writes that must not pass through one task, one sort or one codec that leaves ids as they are."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from salesloom.registry import QUERIES, context, extensions, load_all
from salesloom.session import table_writer
from salesloom.sources.files import read_text_csv

load_all()


@pytest.fixture
def folder(spark, tmp_path):
    """Retail tables of 3,000 lines over three years."""
    lines = [
        (i % 300, i % 5, float(1 + i % 7), float(100 + i), (i % 4) / 20, datetime(1996, 1, 1) + timedelta(days=i * 7 % 1000))
        for i in range(3000)
    ]
    tables = {
        "region": ([(0, "EUROPE")], "r_regionkey long, r_name string"),
        "nation": ([(0, "FRANCE", 0), (1, "SPAIN", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": (
            [(i, i % 2, ("BUILDING", "MACHINERY")[i % 2]) for i in range(10)],
            "c_custkey long, c_nationkey long, c_mktsegment string",
        ),
        "part": (
            [(i, f"part {i}", "type", 10.0 + i) for i in range(5)],
            "p_partkey long, p_name string, p_type string, p_retailprice double",
        ),
        "orders": ([(i, i % 10) for i in range(300)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, "
            "l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


def test_raw_text_is_compressed_and_needs_no_stored_lines(spark, folder, rows_of):
    from salesloom.registry.texts import raw_text

    path = context.raw_csv(spark, folder)
    files = [p.name for p in Path(path.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    assert context._key(spark, folder, "staged") not in context._stored
    assert rows_of(read_text_csv(spark, path)) == sorted(map(tuple, raw_text(context.staged(spark, folder)).collect()), key=str)


def test_rows_are_not_sorted_to_be_written_by_folder(spark, tmp_path):
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", 0)
    df = spark.range(1000).selectExpr("id", "id % 3 as year")
    table_writer(df, ["year"]).parquet(f"{tmp_path}/t")
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    files = list(Path(f"{tmp_path}/t").rglob("part-*.parquet"))
    assert files and all(".zstd." in p.name for p in files)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 1000 and back.where("year <> id % 3").count() == 0


def test_an_arrival_is_written_by_several_tasks(spark, folder, tmp_path, monkeypatch, rows_of):
    made = {}

    def scratch(_, label):
        made[label] = f"{tmp_path}/{label}"
        return made[label]

    star = context.star(spark, folder)
    monkeypatch.setattr(extensions, "scratch_path", scratch)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        found = rows_of(QUERIES["stream2_windowed_rollup"](spark, folder))
    finally:
        for name in small:
            spark.conf.unset(name)
    arrivals = [p for p in Path(made["arriving"]).iterdir() if p.is_dir()]
    assert len(arrivals) == 3
    assert max(len(list(p.glob("part-*.parquet"))) for p in arrivals) > 1

    latest = extensions.deduplicate(star.fact, "latest")
    last = latest.selectExpr("max(transaction_date)").first()[0]
    closed = latest.where(latest.transaction_date + timedelta(days=1) <= last - timedelta(days=30))
    expected = closed.groupBy("transaction_date", "segment_key").agg({"*": "count", "net_sales": "sum"})
    assert found == rows_of(expected.selectExpr(
        "transaction_date as day", "segment_key", "`count(1)` as sales", "cast(`sum(net_sales)` as double) as net_sales"
    ))


def test_release_removes_the_shuffle_files_of_finished_steps(spark, tmp_path):
    import time
    from pathlib import Path

    from salesloom.session import release

    def shuffles():
        folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].toString())
        return {path.name for path in folder.rglob("shuffle_*.data")}

    release(spark)
    before = shuffles()
    spark.range(10_000).repartition(3, "id").write.parquet(str(tmp_path / "rows"))
    made = shuffles() - before
    assert made
    release(spark)
    # Spark removes them on a thread of its own, well within the second that the JVM's proxies alone would wait.
    until = time.monotonic() + 10
    while shuffles() & made and time.monotonic() < until:
        time.sleep(0.05)
    assert not shuffles() & made

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.operators import staging as sg
from salesloom.schemas import RAW_COLUMNS, STAGING, column_comments
from salesloom.sources import files, tables

GOOD = [
    "Retail ", " France", "Lamp", "None", "10", "$3.00", "$7.00", " $1,618.50 ", "$5.00", "$65.00", "$30.00",
    "$35.00", "1/1/2014", "1", " January ", "2014",
]


def raw(spark, **changes):
    row = dict(zip(RAW_COLUMNS, GOOD)) | {k.replace("_", " "): v for k, v in changes.items()}
    return spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS)], files.text_schema(RAW_COLUMNS))


def staged(df, **options):
    return sg.stage(sg.stamp_load(df, "raw_financials"), **options)


def test_typed_relation(spark):
    out = staged(raw(spark))
    assert [f.name for f in out.schema] == [f.name for f in STAGING]
    assert [f.dataType for f in out.schema] == [f.dataType for f in STAGING]
    row = out.first()
    assert row["segment_name"] == "Retail" and row["country_name"] == "France"
    assert row["gross_sales"] == Decimal("1618.50") and row["transaction_date"] == date(2014, 1, 1)
    assert row["month_name"] == "January" and row["year"] == 2014
    assert row["discount_band"] == "None" and row["record_source"] == "raw_financials"
    assert row["load_datetime"] is not None


def test_unreadable_values(spark):
    df = raw(spark, Discounts="$-", Date="soon")
    row = staged(df).first()
    assert row["discounts"] is None and row["transaction_date"] is None
    counts = {r["column_name"]: r["unreadable"] for r in sg.unreadable_counts(df).collect()}
    assert counts["Discounts"] == 1 and sum(counts.values()) == 1
    assert sg.rejected(df).count() == 1 and sg.rejected(raw(spark)).count() == 0
    assert sg.rejected(raw(spark, Profit=None)).count() == 0


def test_strict_staging_raises(spark):
    plain = {c.replace(" ", "_"): v for c, v in zip(RAW_COLUMNS, GOOD)}
    clean = {k: v.replace("$", "").replace(",", "").strip() for k, v in plain.items()}
    assert staged(raw(spark, **{**clean, "Date": "2014-01-01"}), tolerant=False).count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged(raw(spark, **{**clean, "Date": "2014-01-01", "Profit": "$-"}), tolerant=False).collect()


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "in")
    padded = raw(spark, Profit=None).toDF(*[f" {c} " for c in RAW_COLUMNS])
    files.write_csv(padded, path)
    back = files.read_text_csv(spark, path)
    assert back.columns == list(RAW_COLUMNS)
    row = back.first()
    assert row["Discount Band"] == "None" and row["Profit"] is None and row["Segment"] == "Retail "
    assert files.read_text_csv(spark, path, RAW_COLUMNS).first() == row


def test_first_existing_and_landing(spark, tmp_path):
    path = files.land(raw(spark), str(tmp_path), "a")
    assert path.endswith("raw/financials/a")
    chosen = files.first_existing(spark, ["nowhere://bucket/x", str(tmp_path / "absent"), path])
    assert chosen == path
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [str(tmp_path / "absent")])


def test_append_keeps_earlier_stamp(spark, tmp_path):
    path = str(tmp_path / "landed")
    first = F.lit("2020-01-01 00:00:00").cast("timestamp")
    files.append_raw(raw(spark), path, "one", first)
    files.append_raw(raw(spark), path, "two")
    landed = spark.read.parquet(path)
    assert {r["record_source"]: r["load_datetime"].year > 2020 for r in landed.collect()} == {
        "one": False, "two": True,
    }


def test_tables(spark, tmp_path, lines):
    path = str(tmp_path / "t")
    tables.save_table(lines({}, {}), path)
    again = tables.save_table(lines({}), path)
    assert again.count() == 1 and tables.read_table(spark, path).count() == 1
    assert column_comments(spark.read.parquet(path))["net_sales"] == "gross sales less discounts"
    tables.save_view(again, "one_line")
    assert tables.read_table(spark, "one_line").count() == 1


def test_failed_rebuild_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "kept")
    tables.save_table(spark.range(3), path)
    broken = spark.range(3).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("x"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.save_table(broken, path)
    assert spark.read.parquet(path).count() == 3
    doubled = spark.read.parquet(path).unionByName(spark.read.parquet(path))
    assert tables.save_table(doubled, path).count() == 6

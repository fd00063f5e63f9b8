"""Stored tables: views, full rebuilds, year partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesloom.operators.facts import YEAR_COLUMN, with_year
from salesloom.session import table_writer
from salesloom.sources.snapshots import opened


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A declared source: a path (anything with a slash) or a table or view name.

    Of a snapshot table the newest version is read; the frame stays with it.
    """
    if "/" not in source:
        return spark.table(source)
    stored = opened(spark, source)
    return spark.read.parquet(source) if stored is None else stored.read(spark)


def save_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Rebuild the table at ``path`` and return it as stored.

    The new content is complete before it takes the place of the old one, so a
    failed job leaves the previous table.  ``df`` may even read that table.
    Between the removal of the old folder and the move of the new one there is
    no table for a moment: where others read meanwhile, use ``snapshots.publish``.
    """
    spark, new = df.sparkSession, f"{path}.new-{uuid.uuid4().hex[:12]}"
    table_writer(df).parquet(new)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), target):
        raise OSError(f"could not move {new} to {path}")
    return spark.read.schema(df.schema).parquet(path)


def save_by_year(df: DataFrame, path: str, mode: str = "overwrite", grouped: bool = False) -> DataFrame:
    """Store the fact partitioned by sale year.

    ``rebalance`` groups rows by year before the write and splits big years,
    so each task writes few files of an even size.  ``grouped`` skips that
    shuffle for rows that come from a table already stored by year.
    """
    dated = df if YEAR_COLUMN in df.columns else with_year(df)
    spread = dated if grouped else dated.hint("rebalance", YEAR_COLUMN)
    table_writer(spread, [YEAR_COLUMN]).mode(mode).parquet(path)
    return df.sparkSession.read.schema(dated.schema).parquet(path)

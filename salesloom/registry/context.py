"""Tables the registered queries share: stored once per session and data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.plans.reports import REPORTS
from salesloom.plans.warehouse import Settings, Star, build_star
from salesloom.registry.texts import raw_text
from salesloom.schemas import STAGING, conform
from salesloom.session import release, table_writer, scratch_path
from salesloom.sources import retail
from salesloom.sources.files import land
from salesloom.sources.tables import save_table

# The sales days of the retail tables lie inside this calendar.
SPINE = ("1995-01-01", "2002-01-01")
# A calendar that ends too early, to get lines without a date key.
SHORT_SPINE_END = "2000-07-01"
LOADED_AT = "2002-01-01 00:00:00"

_stored: dict[tuple, object] = {}


def _key(spark: SparkSession, folder: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, os.path.abspath(folder), name


def _once(spark: SparkSession, folder: str, name: str, make):
    key = _key(spark, folder, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


def staged(spark: SparkSession, folder: str) -> DataFrame:
    """The staging relation, landed once, by year."""

    def make() -> DataFrame:
        path = scratch_path(spark, "lines")
        lines = retail.sales_lines(spark, folder, loaded_at(), by_year=True)
        table_writer(lines, ["year"]).parquet(path)
        release(spark)
        return conform(spark.read.schema(STAGING).parquet(path), STAGING)

    return _once(spark, folder, "staged", make)


def settings(spark: SparkSession, folder: str, spine_end: str = SPINE[1]) -> Settings:
    return Settings(
        spine_start=SPINE[0],
        spine_end=spine_end,
        regions=retail.country_regions(spark, folder),
        policy="keep_all",
        staged_by_year=True,
        # Registered reports and star queries are made from the fact itself.
        cubes=False,
    )


def star(spark: SparkSession, folder: str) -> Star:
    """The stored warehouse."""
    return _once(
        spark,
        folder,
        "star",
        lambda: build_star(staged(spark, folder), scratch_path(spark, "star"), settings(spark, folder)),
    )


def short_star(spark: SparkSession, folder: str) -> Star:
    """A warehouse whose calendar misses the last days, so some lines are quarantined."""
    return _once(
        spark,
        folder,
        "short_star",
        lambda: build_star(
            staged(spark, folder),
            scratch_path(spark, "short-star"),
            settings(spark, folder, SHORT_SPINE_END),
        ),
    )


def stored_report(spark: SparkSession, folder: str, name: str, which=star) -> DataFrame:
    def make() -> DataFrame:
        return save_table(REPORTS[name](which(spark, folder)), scratch_path(spark, name))

    return _once(spark, folder, f"{which.__name__}-{name}", make)


def raw_csv(spark: SparkSession, folder: str) -> str:
    """All sales lines as the flat text file a user would receive, compressed.

    The lines come from the staging relation if it is stored, else straight
    from the tables: the text alone does not need them grouped and stored by year.
    """

    def make() -> str:
        stored = _key(spark, folder, "staged") in _stored
        lines = staged(spark, folder) if stored else retail.sales_lines(spark, folder, loaded_at())
        return land(raw_text(lines), scratch_path(spark, "raw"), "lines", "gzip")

    return _once(spark, folder, "raw_csv", make)


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """One category per product name: the type of its first part."""
    return (
        retail.table(spark, folder, "part")
        .groupBy(F.col("p_name").alias("product_name"))
        .agg(F.min_by("p_type", "p_partkey").alias("product_category"))
    )

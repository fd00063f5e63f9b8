"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import release, scratch_path

# What separates words is space and the control characters 09 to 0D.
WORD = "[^\\x20\\x09-\\x0D]+"

# Rows of documents are told apart by id and text; equal rows are one document.
ID = "__llm_id"
TEXT_HASH = "__llm_text_hash"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, so that it is computed once.

    What finished steps have left on disk is removed first.  ``path`` is for a
    caller that deletes the rows once they are used up.
    """
    path = path or scratch_path(df.sparkSession, label)
    release(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The text as string, empty where it is missing."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)




# Bits of the filter below: 8 MB, whatever the size of the tables.
FILTER_BITS = 26
_BITS_PER_ROW = 15


def likely_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose long ``key`` may be in ``wanted`` (one column), none of those that are lost.

    A bitmap of fixed size is broadcast, a bit per hash value.  With more wanted
    keys it lets more rows through; a join must follow that decides.
    """

    def places(column) -> tuple[Column, Column]:
        value = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
        return F.shiftright(value, _BITS_PER_ROW), F.pmod(value, F.lit(1 << _BITS_PER_ROW))

    row, bit = places(wanted[wanted.columns[0]])
    bitmaps = wanted.select(row.alias("__llm_row"), bit.alias("__llm_bit")).groupBy("__llm_row").agg(
        F.bitmap_construct_agg("__llm_bit").alias("__llm_bits")
    )
    row, bit = places(df[key])
    at = (F.shiftright(bit, 3) + 1).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__llm_bits"), at, F.lit(1))), 16, 10).cast("int")
    return (
        df.withColumn("__llm_row", row)
        .join(F.broadcast(bitmaps), "__llm_row")
        .where(F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)
        .drop("__llm_row", "__llm_bits")
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='salesloom-')}/salesloom", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)

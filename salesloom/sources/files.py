"""Flat-file sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators.staging import stamp_load, strip_headers
from salesloom.sources.storage import path_exists

# Fixed value: folder under which raw files are landed.
LANDING_PREFIX = "raw/financials"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column as text and header blanks removed.

    Without ``columns`` the names come from the header line alone: no pass over
    the data infers types.  The word ``None`` stays a value; only an empty
    field is NULL.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("enforceSchema", True)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return strip_headers(reader.csv(path))


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists; object stores and local folders alike are Hadoop paths."""
    for path in paths:
        try:
            if path_exists(spark, path):
                return path
        except Exception:  # an unreachable store counts as absent, the next path is tried
            continue
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_first_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    return read_text_csv(spark, first_existing(spark, paths), columns)


def land(df: DataFrame, root: str, name: str, compression: str = "none") -> str:
    """Write raw rows unchanged below the landing prefix and return their path."""
    path = f"{root}/{LANDING_PREFIX}/{name}"
    write_csv(df, path, compression)
    return path


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with a header; blanks inside the values are kept.

    With ``compression`` (``gzip``) the text takes a fraction of the space and
    is read as before, each file by one task.
    """
    writer = df.write.mode("overwrite").option("header", True).option("compression", compression)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def append_raw(df: DataFrame, path: str, record_source: str, loaded_at: Column | None = None) -> None:
    """Append raw rows to the landed table, stamped with load time and origin."""
    plain = df.select(*[F.col(f"`{c}`") for c in df.columns])
    stamp_load(plain, record_source, loaded_at).write.mode("append").parquet(path)

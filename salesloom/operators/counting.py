"""Counting values and finding repeated rows without moving whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.ordering import BROADCAST_ROWS
from salesloom.session import checkpointed


def counts_by_value(df: DataFrame, columns: Sequence[str], value_type: str) -> DataFrame:
    """Rows per value of each column, NULL included, in one scan: ``(column_name, value, n)``."""
    typed = df.select(*[F.col(f"`{c}`").cast(value_type).alias(c) for c in columns])
    pairs = typed.unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "value")
    return pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def split_by_repeats(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """Split ``df`` into rows that may share ``columns`` with another row, and rows that do not.

    Only 8-byte hashes are shuffled over the whole frame.  Rows with a repeated
    hash are the first part: all true repeats and the odd hash collision.  None
    if there is no repeated hash at all.  Where the repeated hashes are too many
    to be broadcast, all rows are the first part: to look each row up would move
    it once for either part, and the aggregate that follows moves it only once.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*columns))
    repeated = checkpointed(
        hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    )
    size = repeated.count()
    if size == 0:
        return None
    if size > BROADCAST_ROWS:
        return df, df.limit(0)
    known = F.broadcast(repeated)
    shared = hashed.join(known, "_hash", "left_semi").drop("_hash")
    return shared, hashed.join(known, "_hash", "left_anti").drop("_hash")


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations of ``columns`` on more than one row, with their row count ``_copies``; NULLs are equal."""
    narrow = df.select(*columns)
    parts = split_by_repeats(narrow, columns)
    candidates = narrow.limit(0) if parts is None else parts[0]
    return candidates.groupBy(*columns).agg(F.count("*").alias("_copies")).where("_copies > 1")


def surplus_rows(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row: how many rows repeat an earlier row in ``columns``."""
    extra = F.sum(F.col("_copies") - 1)
    return repeated_values(df, columns).agg(F.coalesce(extra, F.lit(0)).cast("bigint").alias(name))

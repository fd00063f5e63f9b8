"""The sales fact: key lookup over the dimensions, row id, quarantine flag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.text import hashed_key
from salesloom.operators.counting import split_by_repeats
from salesloom.operators.history import as_of
from salesloom.operators.ordering import bounded_broadcast
from salesloom.schemas import FACT, conform

# The fields of the row id, in order.
NATURAL_KEY = (
    "transaction_date", "product_name", "segment_name", "country_name", "discount_band", "units_sold",
)
KEYS = ("date_key", "product_key", "segment_key", "geography_key", "discount_key")
YEAR_COLUMN = "sale_year"


def lookup(lines: DataFrame, dim: DataFrame, on: dict[str, str], key: str, rows: int | None = None) -> DataFrame:
    """Left join ``lines`` to ``dim`` and keep only its ``key``; unmatched lines get NULL.

    ``on`` maps a line column to a dimension column.
    """
    narrow = dim.select(*[F.col(d).alias(f"_{d}") for d in on.values()], key)
    match = reduce(lambda a, b: a & b, [F.col(s) == F.col(f"_{d}") for s, d in on.items()])
    return lines.join(bounded_broadcast(narrow, rows), match, "left").drop(*[f"_{d}" for d in on.values()])


def identified(staged: DataFrame) -> DataFrame:
    """Staged lines with their row id."""
    return staged.withColumn("transaction_id", hashed_key(NATURAL_KEY))


def sales_fact(
    staged: DataFrame,
    dims: dict[str, DataFrame],
    rows: dict[str, int] | None = None,
    product_join: str = "current",
) -> DataFrame:
    """One fact row per staged line.

    ``dims`` holds ``dim_date``, ``dim_product``, ``dim_segment``,
    ``dim_geography`` and ``dim_discount``; ``rows`` their sizes if known.
    Lines that miss a dimension stay in, flagged by ``has_missing_keys``.
    ``product_join`` says which version of a product a line points at: the
    ``current`` one, or ``as_of`` its day, the newest that had begun by then.
    """
    if product_join not in ("current", "as_of"):
        raise ValueError(f"unknown product join {product_join!r}")
    rows = rows or {}
    lines = staged if "transaction_id" in staged.columns else identified(staged)
    products = dims["dim_product"]
    if product_join == "as_of":
        price = F.col("manufacturing_price")
        tie = [price.isNull(), price]
        lines = as_of(lines, products, "product_name", "transaction_date", "effective_date", ["product_key"], tie)
    else:
        current = products.where(F.col("is_current"))
        lines = lookup(lines, current, {"product_name": "product_name"}, "product_key", rows.get("dim_product"))
    for name, dim, on, key in (
        ("dim_date", dims["dim_date"], {"transaction_date": "date_day"}, "date_key"),
        ("dim_segment", dims["dim_segment"], {"segment_name": "segment_name"}, "segment_key"),
        ("dim_geography", dims["dim_geography"], {"country_name": "country_name"}, "geography_key"),
        ("dim_discount", dims["dim_discount"], {"discount_band": "discount_band"}, "discount_key"),
    ):
        lines = lookup(lines, dim, on, key, rows.get(name))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in KEYS])
    return conform(
        lines.withColumns(
            {
                "profit": F.coalesce("profit", F.col("net_sales") - F.col("cogs")),
                "load_date": F.col("load_datetime"),
                "has_missing_keys": missing,
            }
        ),
        FACT,
    )


def deduplicate(fact: DataFrame, policy: str = "error", loaded: str = "load_date") -> DataFrame:
    """Apply a policy for rows that share a ``transaction_id``.

    ``keep_all`` leaves them, ``latest`` keeps the one loaded last by column
    ``loaded`` (ties by the measures), ``error`` raises if an id repeats.
    """
    if policy == "keep_all":
        return fact
    if policy not in ("latest", "error"):
        raise ValueError(f"unknown policy {policy!r}")
    parts = split_by_repeats(fact, ["transaction_id"])
    if parts is None:
        return fact
    shared, single = parts
    if policy == "error":
        copies = shared.groupBy("transaction_id").agg(F.count("*").alias("n")).where("n > 1")
        repeated = copies.agg(F.count("*").alias("ids"), F.min("transaction_id").alias("id")).first()
        if repeated["ids"]:
            raise ValueError(f"{repeated['ids']} repeated transaction ids, for example {repeated['id']}")
        return fact
    # A struct maximum combines before the shuffle, so a hot id stays one row per task.
    rank = [loaded, "net_sales", "gross_sales", "cogs", "profit", "sale_price"]
    rest = [c for c in fact.columns if c not in {"transaction_id", *rank}]
    newest = shared.groupBy("transaction_id").agg(F.max(F.struct(*rank, *rest)).alias("_row"))
    picked = newest.select("transaction_id", "_row.*")
    return single.unionByName(
        picked.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in fact.schema])
    )


def repeated_ids(fact: DataFrame, large: bool = True) -> DataFrame:
    """Surplus rows: ids carried by more than one row, and rows without an id, with their keys.

    With it, ``count(distinct transaction_id)`` becomes additive: rows less
    ``surplus``.  ``mixed`` marks an id whose copies differ in a key, for which
    that shortcut would not hold; it comes with the least of each key, NULL first.  ``large`` looks for repeated hashes first,
    so that ids that occur once are not shuffled.
    """
    flags = [*KEYS, "has_missing_keys"]
    rows = fact.select("transaction_id", *flags)
    named = rows.where(F.col("transaction_id").isNotNull())
    shared = named
    if large:
        parts = split_by_repeats(named, ["transaction_id"])
        shared = named.limit(0) if parts is None else parts[0]
    # Each key by itself, as numbers: a hash aggregate adds up where the rows are read, and sorts none.
    counted = shared.groupBy("transaction_id").agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in flags for name, f in (("low", F.min), ("high", F.max), ("given", F.count))],
    )
    differs = [
        F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False)) | ~F.col(f"given_{c}").isin(F.lit(0), F.col("n"))
        for c in flags
    ]
    copies = counted.where("n > 1").select(
        "transaction_id",
        *[F.when(F.col(f"given_{c}") == F.col("n"), F.col(f"low_{c}")).alias(c) for c in flags],
        (F.col("n") - 1).alias("surplus"),
        reduce(lambda a, b: a | b, differs).alias("mixed"),
    )
    nameless = (
        rows.where(F.col("transaction_id").isNull())
        .groupBy("transaction_id", *flags)
        .agg(F.count("*").alias("surplus"), F.lit(False).alias("mixed"))
    )
    return copies.unionByName(nameless)


def with_year(fact: DataFrame) -> DataFrame:
    """Add the partition column of the stored fact."""
    return fact.withColumn(YEAR_COLUMN, F.year("transaction_date"))

"""Dimensions that grow with arriving lines, without the lines of earlier loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators import dimensions as dm


def _known_and_new(existing: DataFrame, lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Members of a dimension and of new lines, in the columns the builders read from lines."""
    known = existing.select(*[F.col(stored).alias(name) for name, stored in columns.items()])
    return known.unionByName(lines.select(*columns))


def extended_dimensions(
    existing: dict[str, DataFrame],
    lines: DataFrame,
    regions: DataFrame | None = None,
    bands: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each dimension that lines can extend, from its members so far and the new ``lines``.

    Known members keep their keys.  A product version is known by name and
    price; its first day moves back if an earlier sale arrives, and the ends of
    the versions follow.
    """
    price = {"product_name": "product_name", "manufacturing_price": "manufacturing_price", "transaction_date": "effective_date"}

    def members(name: str, columns: dict[str, str]) -> DataFrame:
        return _known_and_new(existing[name], lines, columns)

    return {
        "dim_product": lambda: dm.dim_product(members("dim_product", price), existing["dim_product"]),
        "dim_segment": lambda: dm.dim_segment(
            members("dim_segment", {"segment_name": "segment_name"}), existing["dim_segment"]
        ),
        "dim_geography": lambda: dm.dim_geography(
            members("dim_geography", {"country_name": "country_name"}), regions, existing["dim_geography"]
        ),
        "dim_discount": lambda: dm.dim_discount(
            members("dim_discount", {"discount_band": "discount_band"}), bands, existing["dim_discount"]
        ),
    }

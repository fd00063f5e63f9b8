"""Column expressions shared by the reports: sums, ratios, growth, classes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# total column -> fact column it adds up
TOTALS = {
    "gross_sales": "gross_sales",
    "total_discounts": "discounts",
    "net_sales": "net_sales",
    "total_cogs": "cogs",
    "total_profit": "profit",
    "units_sold": "units_sold",
}


def _double(column: Column) -> Column:
    return column.cast("double")


def quotient(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL where the denominator is zero."""
    return _double(numerator) / F.nullif(_double(denominator), F.lit(0.0))


def rounded(value: Column, digits: int = 2) -> Column:
    """Round half away from zero, on the decimal image of a double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column, factor: float = 1.0) -> Column:
    """``factor * numerator / denominator`` rounded to cents."""
    return rounded(
        _double(numerator) * F.lit(float(factor)) / F.nullif(_double(denominator), F.lit(0.0))
    )


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 100.0)


def growth_percent(current: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent; NULL where it is missing or zero."""
    return percent(current - previous, previous)


def change(current: Column, previous: Column) -> Column:
    """Absolute change; a missing previous value counts as zero."""
    return current - F.coalesce(previous, F.lit(0).cast("decimal(18,2)"))


def at_least(numerator: Column, denominator: Column, bound: tuple[int, int]) -> Column:
    """Whether ``numerator / denominator`` reaches the fraction ``bound``, on exact decimals; NULL over zero."""
    above, below = bound
    n, d = numerator.cast("decimal(28,2)"), F.nullif(denominator.cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))
    left, right = n * F.lit(Decimal(below)), d * F.lit(Decimal(above))
    return F.when(d > 0, left >= right).otherwise(left <= right) & d.isNotNull()


def ladder(numerator: Column, denominator: Column, *steps: tuple[tuple[int, int], str], otherwise: str) -> Column:
    """Label of the first step whose bound the quotient reaches; NULL falls to ``otherwise``."""
    out = None
    for bound, label in steps:
        reached = at_least(numerator, denominator, bound)
        out = F.when(reached, label) if out is None else out.when(reached, label)
    return out.otherwise(otherwise)


def profit_category(profit: Column, net_sales: Column) -> Column:
    # Margin bounds and labels.
    return ladder(
        profit,
        net_sales,
        ((1, 5), "High Margin"),
        ((1, 10), "Medium Margin"),
        ((0, 1), "Low Margin"),
        otherwise="Loss Making",
    )


def discount_effectiveness(profit: Column, discounts: Column) -> Column:
    # Return bounds and labels.
    earned = ladder(
        profit,
        discounts,
        ((3, 1), "Highly Effective"),
        ((1, 1), "Effective"),
        otherwise="Ineffective",
    )
    return F.when(profit <= 0, "Loss Making").otherwise(earned)

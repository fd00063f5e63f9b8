"""Data-quality checks and the quality dashboard.

Checks yield rows ``(check, table_name, column_name, severity, violations,
status)``, so that any number of them is one frame with one verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.counting import counts_by_value, repeated_values
from salesloom.operators.facts import KEYS
from salesloom.operators.rules import PLAUSIBLE, tallies, violations
from salesloom.plans.warehouse import Star
from salesloom.session import checkpointed

FACT_NAME = "fact_financial_transactions"

# Declared key rules of each table.
UNIQUE = {
    "dim_date": ("date_key", "date_day"),
    "dim_segment": ("segment_key", "segment_name"),
    "dim_product": ("product_key",),
    "dim_geography": ("geography_key", "country_name"),
    "dim_discount": ("discount_key", "discount_band"),
    FACT_NAME: ("transaction_id",),
}
NOT_NULL = {
    **{t: c for t, c in UNIQUE.items() if t != FACT_NAME},
    "dim_product": ("product_key", "product_name"),
    FACT_NAME: ("transaction_id", *KEYS, "units_sold", "gross_sales", "net_sales", "cogs", "profit"),
}
RELATIONSHIPS = {
    "date_key": "dim_date",
    "product_key": "dim_product",
    "segment_key": "dim_segment",
    "geography_key": "dim_geography",
    "discount_key": "dim_discount",
}

CHECK_COLUMNS = ("check", "table_name", "column_name", "severity", "violations", "status")


def _tally(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def check_rows(counts: DataFrame, check: str, table: str, severity: str = "error") -> DataFrame:
    """Turn ``(column_name, violations)`` into check rows."""
    failed = F.col("violations") > 0
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        "column_name",
        F.lit(severity).alias("severity"),
        F.col("violations").cast("bigint").alias("violations"),
        F.when(failed, F.lit("warn" if severity == "warn" else "fail")).otherwise("pass").alias("status"),
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts of all columns in one pass."""
    counts = df.agg(*[_tally(F.col(c).isNull()).alias(c) for c in columns])
    return check_rows(counts.unpivot([], list(columns), "column_name", "violations"), "not_null", table)


def unique(df: DataFrame, table: str, columns: Sequence[str], large: bool = False) -> DataFrame:
    """Values that occur more than once, per column; NULL is not a value.

    ``large`` looks for repeated hashes first, so long values are not shuffled.
    """

    def repeated(column: str) -> DataFrame:
        named = df.where(F.col(column).isNotNull())
        if large:
            values = repeated_values(named, [column])
        else:
            values = named.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
        return values.agg(F.count("*").alias("violations")).select(
            F.lit(column).alias("column_name"), "violations"
        )

    return check_rows(reduce(DataFrame.unionByName, map(repeated, columns)), "unique", table)


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows per key column that match no dimension row.

    ``orphans`` counts a NULL key too, ``dangling`` only keys that have a value.
    The fact is counted by key before it meets the dimensions, so only distinct
    keys travel.
    """
    known = reduce(
        DataFrame.unionByName,
        [
            dims[dim].select(F.lit(key).alias("column_name"), F.col(key).cast("bigint").alias("key")).distinct()
            for key, dim in RELATIONSHIPS.items()
        ],
    ).withColumn("known", F.lit(True))
    lost = F.col("known").isNull()
    # A zero count per column keeps every relationship in the result of an empty fact.
    zeros = fact.sparkSession.createDataFrame(
        [(k, None, 0) for k in KEYS], "column_name string, value bigint, n bigint"
    )
    keys = counts_by_value(fact, KEYS, "bigint").unionByName(zeros).withColumnRenamed("value", "key")
    joined = keys.join(known, ["column_name", "key"], "left")
    return joined.groupBy("column_name").agg(
        F.sum("n").alias("fact_count"),
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("orphans"),
        F.sum(F.when(lost & F.col("key").isNotNull(), F.col("n")).otherwise(0)).alias("dangling"),
    )


def relationships(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Keys with a value that point at no dimension row."""
    counts = orphan_counts(fact, dims).select("column_name", F.col("dangling").alias("violations"))
    return check_rows(counts, "relationships", FACT_NAME)


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows without a dimension row, a NULL key included."""
    counts = orphan_counts(fact, dims).select("column_name", F.col("orphans").alias("violations"))
    return check_rows(counts, "referential_integrity", FACT_NAME)


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """One violation per table without rows; reads at most one row of each."""

    def probe(name: str, df: DataFrame) -> DataFrame:
        empty = df.limit(1).agg((1 - F.count("*")).alias("violations"))
        return check_rows(
            empty.select(F.lit("*").alias("column_name"), "violations"), "non_empty", name
        )

    return reduce(DataFrame.unionByName, [probe(n, t) for n, t in tables.items()])


def row_rules(fact: DataFrame) -> DataFrame:
    """Counts of rows that break a plausibility rule, in one pass; they warn, never fail."""
    counts = violations(fact, PLAUSIBLE).select(F.col("rule").alias("column_name"), "violations")
    return check_rows(counts, "row_rule", FACT_NAME, "warn")


@dataclass(frozen=True)
class FactCounts:
    """All that the checks and the dashboard need of the fact, from two scans of it.

    ``tallies`` is one row of counts and totals, ``keys`` the orphans per key,
    ``repeats`` one row: repeated ids and rows in excess of distinct ids.
    """

    tallies: DataFrame
    keys: DataFrame
    repeats: DataFrame


# check of reconciliation -> total of the fact, report, its column
RECONCILED = {
    "monthly_sales": ("net_sales", "monthly_sales_analysis", "net_sales"),
    "product_profit": ("profit", "product_profitability", "total_profit"),
    "segment_sales": ("net_sales", "segment_performance", "net_sales"),
}


def _fact_totals() -> list[Column]:
    return [F.sum(total).cast("decimal(38,2)").alias(name) for name, (total, _, _) in RECONCILED.items()]


def _fact_tallies() -> list[Column]:
    def tally(name: str, condition: Column) -> Column:
        return F.count_if(condition).alias(name)

    return [
        F.count(F.lit(1)).alias("row_count"),
        tally("null_key_count", F.col("transaction_id").isNull()),
        tally("records_with_missing_keys", F.col("has_missing_keys")),
        tally("negative_sales_count", F.col("net_sales") < 0),
        tally("negative_profit_count", F.col("profit") < 0),
        tally("inconsistent_units_count", (F.col("units_sold") <= 0) & (F.col("net_sales") > 0)),
        *[tally(f"null_{c}", F.col(c).isNull()) for c in NOT_NULL[FACT_NAME]],
        *tallies(PLAUSIBLE),
        *_fact_totals(),
    ]


def _repeats(star: Star) -> DataFrame:
    """One row: ``repeated_ids`` and ``surplus`` rows, from the stored surplus rows if the star has them."""
    if star.repeats is not None:
        per_id = star.repeats.groupBy("transaction_id").agg(F.sum("surplus").alias("n")).where("n > 0")
        named = F.col("transaction_id").isNotNull()
        return per_id.agg(
            F.count_if(named).alias("repeated_ids"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("surplus")
        )
    named = star.fact.where(F.col("transaction_id").isNotNull())
    copies = repeated_values(named, ["transaction_id"]).agg(
        F.count("*").alias("repeated_ids"), F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("surplus")
    )
    without = star.fact.where(F.col("transaction_id").isNull()).agg(F.count("*").alias("surplus"))
    both = copies.unionByName(without, allowMissingColumns=True)
    return both.agg(F.max("repeated_ids").alias("repeated_ids"), F.sum("surplus").cast("bigint").alias("surplus"))


def count_fact(star: Star) -> FactCounts:
    """Scan the fact once for all tallies and totals and once by key."""
    return FactCounts(
        checkpointed(star.fact.agg(*_fact_tallies())),
        checkpointed(orphan_counts(star.fact, star.dims)),
        checkpointed(_repeats(star)),
    )


def _listed(counts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Some counts of a one-row frame as ``(column_name, violations)``."""
    return counts.select(*[F.col(old).alias(new) for new, old in columns.items()]).unpivot(
        [], list(columns), "column_name", "violations"
    )


def reconciliation(fact: DataFrame, reports: dict[str, DataFrame]) -> DataFrame:
    """Totals of three reports against the whole fact: ``(name, fact_total, report_total, difference)``."""
    return _against_reports(fact.agg(*_fact_totals()), reports)


def _against_reports(totals: DataFrame, reports: dict[str, DataFrame]) -> DataFrame:
    rows = totals.select(*RECONCILED).unpivot([], list(RECONCILED), "name", "fact_total")
    for name, (_, report, column) in RECONCILED.items():
        total = F.sum(column).cast("decimal(38,2)").alias("report_total")
        one = reports[report].agg(F.lit(name).alias("name"), total)
        rows = rows.unionByName(one, allowMissingColumns=True)
    sides = rows.groupBy("name").agg(
        F.max("fact_total").alias("fact_total"), F.max("report_total").alias("report_total")
    )
    return sides.withColumn("difference", F.abs(F.col("fact_total") - F.col("report_total")))


def reconciled(fact: DataFrame, reports: dict[str, DataFrame], tolerance: int = 1) -> DataFrame:
    """Check rows: a difference above the tolerance is a violation."""
    return _differences(reconciliation(fact, reports), tolerance)


def _differences(sides: DataFrame, tolerance: int = 1) -> DataFrame:
    off = F.coalesce(F.col("difference") > tolerance, F.lit(True))
    counts = sides.select(
        F.concat("name", F.lit("_totals_match_fact")).alias("column_name"),
        off.cast("bigint").alias("violations"),
    )
    return check_rows(counts, "reconciliation", FACT_NAME)


def declared_tests(star: Star) -> DataFrame:
    """The key rules declared for each table."""
    tables = {**star.dims, FACT_NAME: star.fact}
    parts = [not_null(tables[t], t, c) for t, c in NOT_NULL.items()]
    parts += [unique(tables[t], t, c, large=t == FACT_NAME) for t, c in UNIQUE.items()]
    parts.append(relationships(star.fact, star.dims))
    return reduce(DataFrame.unionByName, parts)


def run_checks(star: Star, reports: dict[str, DataFrame]) -> DataFrame:
    """Every check over the warehouse as one frame; the fact is scanned twice."""
    counts = count_fact(star)
    parts = [not_null(star.dims[t], t, c) for t, c in NOT_NULL.items() if t != FACT_NAME]
    parts += [unique(star.dims[t], t, c) for t, c in UNIQUE.items() if t != FACT_NAME]
    nulls = _listed(counts.tallies, {c: f"null_{c}" for c in NOT_NULL[FACT_NAME]})
    parts.append(check_rows(nulls, "not_null", FACT_NAME))
    parts.append(check_rows(_listed(counts.repeats, {"transaction_id": "repeated_ids"}), "unique", FACT_NAME))
    for check, column in (("relationships", "dangling"), ("referential_integrity", "orphans")):
        parts.append(check_rows(counts.keys.select("column_name", F.col(column).alias("violations")), check, FACT_NAME))
    parts.append(non_empty({**star.dims, FACT_NAME: star.fact, **reports}))
    broken = _listed(counts.tallies, {rule.name: rule.name for rule in PLAUSIBLE})
    parts.append(check_rows(broken, "row_rule", FACT_NAME, "warn"))
    parts.append(_differences(_against_reports(counts.tallies, reports)))
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: passed unless a check of severity ``error`` failed."""
    failed = F.col("status") == "fail"
    return checks.agg(
        F.coalesce(F.every(~failed), F.lit(True)).alias("passed"),
        F.count("*").alias("checks"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
    )


def share_status(count: Column, total: Column, warn_below: str) -> Column:
    """Good at zero, Warning below a share of the total, else Error."""
    bound = total * F.lit(warn_below).cast("decimal(4,2)")
    return F.when(count == 0, "Good").when((count > 0) & (count < bound), "Warning").otherwise("Error")


def _zero_status(count: Column, bad: str) -> Column:
    return F.when(count == 0, "Good").otherwise(bad)


def status_icon(status: Column) -> Column:
    # Icon of each status.
    return (
        F.when(status == "Good", "✅")
        .when(status == "Warning", "⚠️")
        .when(status == "Error", "❌")
        .otherwise("❓")
    )


def _metric(category: str, name: Column, value: Column, kind: str, status: Column) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        name.alias("metric_name"),
        value.cast("string").alias("metric_value"),
        F.lit(kind).alias("metric_type"),
        status.alias("status"),
    )


def dimension_counts(dims: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Rows, NULL keys and duplicate keys per dimension.

    A NULL key also counts as a duplicate.  The calendar's key counts are
    reported as 0 unless ``strict``.
    """

    def one(key: str, dim: str) -> DataFrame:
        rows = F.count("*")
        if dim == "dim_date" and not strict:
            nulls, copies = F.lit(0), F.lit(0)
        else:
            nulls = F.sum(F.when(F.col(key).isNull(), 1).otherwise(0))
            copies = rows - F.count_distinct(key)
        return dims[dim].agg(
            F.lit(dim).alias("dimension_table"),
            rows.alias("row_count"),
            nulls.cast("bigint").alias("null_key_count"),
            copies.cast("bigint").alias("duplicate_key_count"),
        )

    return reduce(DataFrame.unionByName, [one(k, d) for k, d in RELATIONSHIPS.items()])


METRICS = (
    "row_count", "null_key_count", "records_with_missing_keys", "negative_sales_count", "negative_profit_count",
    "inconsistent_units_count", "duplicate_key_count",
)


def _metric_row(tallied: DataFrame, repeats: DataFrame) -> DataFrame:
    # Two one-row frames folded into one.
    copies = repeats.select(F.col("surplus").alias("duplicate_key_count"))
    both = tallied.unionByName(copies, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in METRICS])


def fact_metrics(fact: DataFrame) -> DataFrame:
    """One row of counts over the fact.

    ``duplicate_key_count`` is rows less distinct ids: surplus copies and rows without an id.
    """
    return _metric_row(fact.agg(*_fact_tallies()), _repeats(Star(fact, {})))


def data_quality_dashboard(star: Star, reports: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Thirty quality metrics with status and icon; the fact is read twice, once by key."""
    c, metrics, counts = F.col, [], count_fact(star)

    area = "Dimension Tables"
    table = c("dimension_table")
    metrics.append(
        dimension_counts(star.dims, strict).select(
            F.explode(
                F.array(
                    _metric(area, table, c("row_count"), "Count",
                            F.when(c("row_count") > 0, "Good").otherwise("Error")),
                    _metric(area, F.concat(table, F.lit(" - Null Keys")), c("null_key_count"), "Count",
                            _zero_status(c("null_key_count"), "Error")),
                    _metric(area, F.concat(table, F.lit(" - Duplicate Keys")), c("duplicate_key_count"),
                            "Count", _zero_status(c("duplicate_key_count"), "Error")),
                )
            ).alias("m")
        )
    )

    area, total = "Fact Table", c("row_count")
    statuses = {
        "Null Keys": ("null_key_count", _zero_status(c("null_key_count"), "Error")),
        "Duplicate Keys": ("duplicate_key_count", _zero_status(c("duplicate_key_count"), "Error")),
        "Records With Missing Keys": (
            "records_with_missing_keys", share_status(c("records_with_missing_keys"), total, "0.01")),
        "Negative Sales": ("negative_sales_count", _zero_status(c("negative_sales_count"), "Warning")),
        "Negative Profit": (
            "negative_profit_count", share_status(c("negative_profit_count"), total, "0.05")),
        "Inconsistent Units": (
            "inconsistent_units_count", _zero_status(c("inconsistent_units_count"), "Warning")),
    }
    rows = [_metric(area, F.lit(FACT_NAME), total, "Count", F.when(total > 0, "Good").otherwise("Error"))]
    rows += [
        _metric(area, F.lit(f"{FACT_NAME} - {label}"), c(column), "Count", status)
        for label, (column, status) in statuses.items()
    ]
    metrics.append(_metric_row(counts.tallies, counts.repeats).select(F.explode(F.array(*rows)).alias("m")))

    relation = F.replace(c("column_name"), F.lit("_key"), F.lit("_dimension"))
    metrics.append(
        counts.keys.select(
            _metric("Referential Integrity", relation, c("orphans"), "Orphaned Records",
                    _zero_status(c("orphans"), "Error")).alias("m")
        )
    )
    agrees = F.when(c("difference") < 1, "Consistent").otherwise("Inconsistent")
    metrics.append(
        _against_reports(counts.tallies, reports).select(
            _metric("Analytical Consistency", F.concat("name", F.lit("_vs_fact")), c("difference"),
                    "Difference", agrees).alias("m")
        )
    )
    combined = reduce(DataFrame.unionByName, metrics).select("m.*")
    rank = (
        F.when(c("category") == "Dimension Tables", 1)
        .when(c("category") == "Fact Table", 2)
        .when(c("category") == "Referential Integrity", 3)
        .when(c("category") == "Analytical Consistency", 4)
        .otherwise(5)
    )
    return combined.withColumns(
        {"status_icon": status_icon(c("status")), "checked_at": F.current_timestamp()}
    ).orderBy(rank, "metric_name")

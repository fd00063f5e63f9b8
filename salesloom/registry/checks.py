"""Registered queries: data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators import quality as dq
from salesloom.plans.reports import REPORTS
from salesloom.plans.warehouse import Star
from salesloom.registry import context as ctx
from salesloom.registry import query
from salesloom.registry.oracle import on_short_star, on_star, sums


def _check(check: str, table: str, counts: dict[str, str], severity: str = "error") -> str:
    """One check row per ``column: expression over f``."""
    bad = "warn" if severity == "warn" else "fail"
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{c}' AS column_name, "
        f"'{severity}' AS severity, CAST(v AS BIGINT) AS violations, "
        f"CASE WHEN v > 0 THEN '{bad}' ELSE 'pass' END AS status FROM ({e})"
        for c, e in counts.items()
    )


def _stored_reports(spark, folder, which):
    return {name: ctx.stored_report(spark, folder, name, which) for name in REPORTS}


def _damaged(spark, folder) -> Star:
    """A warehouse with planted defects, each on whole groups of rows.

    One segment left its dimension, a band's rows lost their product key, the
    highest year has negative sales, and a country's rows have no cost.
    """
    star = ctx.short_star(spark, folder)
    fact = star.fact.withColumns(
        {
            "product_key": F.when(F.col("discount_key") != 1, F.col("product_key")),
            "net_sales": F.when(F.col("sale_year") < 2001, F.col("net_sales")).otherwise(-F.col("net_sales")),
            "cogs": F.when(F.col("geography_key") != 3, F.col("cogs")),
        }
    )
    dims = {**star.dims, "dim_segment": star.dims["dim_segment"].where("segment_key <> 2")}
    return Star(fact, dims, None, star.rows)


DAMAGED = """, damaged AS (
  SELECT * REPLACE (CASE WHEN discount_key <> 1 THEN product_key END AS product_key,
    CASE WHEN transaction_date < DATE '2001-01-01' THEN net_sales ELSE -net_sales END AS net_sales,
    CASE WHEN geography_key <> 3 THEN cogs END AS cogs) FROM fact),
fewer_segments AS (SELECT * FROM dim_segment WHERE segment_key <> 2)
"""


def _nulls(columns, table="damaged"):
    return {c: f"SELECT count(*) - count({c}) AS v FROM {table}" for c in columns}


@query(
    "dq1_not_null",
    on_short_star(DAMAGED + _check("not_null", dq.FACT_NAME, _nulls(dq.NOT_NULL[dq.FACT_NAME]))),
)
def dq1(spark, folder):
    fact = _damaged(spark, folder).fact
    return dq.not_null(fact, dq.FACT_NAME, dq.NOT_NULL[dq.FACT_NAME])


def _repeats(columns, table):
    return {
        c: f"SELECT count(*) AS v FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        for c in columns
    }


_KEYED = {t: "fact" if t == dq.FACT_NAME else t for t in dq.UNIQUE}
_DECLARED = {**dq.UNIQUE, "dim_product": ("product_key", "product_name"), dq.FACT_NAME: ("transaction_id", "date_key")}


@query(
    "dq2_unique",
    on_star(" UNION ALL ".join(_check("unique", t, _repeats(c, _KEYED[t])) for t, c in _DECLARED.items())),
)
def dq2(spark, folder):
    """Every declared key, and two columns that do repeat; the fact's by the route for large tables."""
    star = ctx.star(spark, folder)
    tables = {**star.dims, dq.FACT_NAME: star.fact}
    checks = [dq.unique(tables[t], t, c, large=t == dq.FACT_NAME) for t, c in _DECLARED.items()]
    return reduce(DataFrame.unionByName, checks)


_SIDES = {
    "date_key": "dim_date",
    "product_key": "dim_product",
    "segment_key": "fewer_segments",
    "geography_key": "dim_geography",
    "discount_key": "dim_discount",
}


def _orphans(condition: str = ""):
    return {
        k: f"SELECT count(*) AS v FROM damaged f LEFT JOIN {d} d ON f.{k} = d.{k} WHERE d.{k} IS NULL "
        + condition.format(k=k)
        for k, d in _SIDES.items()
    }


@query(
    "dq3_relationships",
    on_short_star(DAMAGED + _check("relationships", dq.FACT_NAME, _orphans("AND f.{k} IS NOT NULL"))),
)
def dq3(spark, folder):
    star = _damaged(spark, folder)
    return dq.relationships(star.fact, star.dims)


_TABLES = ("dim_date", "dim_product", "dim_segment", "dim_geography", "dim_discount", "fact")


@query(
    "dq4_non_empty",
    on_star(
        " UNION ALL ".join(
            _check(
                "non_empty",
                dq.FACT_NAME if t == "fact" else t,
                {"*": f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS v FROM {t}"},
            )
            for t in _TABLES
        )
        + " UNION ALL "
        + " UNION ALL ".join(
            _check("non_empty", r, {"*": "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS v FROM clean"})
            for r in REPORTS
        )
    ),
)
def dq4(spark, folder):
    """Twelve tables, at least one row each."""
    star = ctx.star(spark, folder)
    return dq.non_empty(
        {**star.dims, dq.FACT_NAME: star.fact, **_stored_reports(spark, folder, ctx.star)}
    )


@query(
    "dq5_orphan_counts",
    on_short_star(DAMAGED + _check("referential_integrity", dq.FACT_NAME, _orphans())),
)
def dq5(spark, folder):
    """A NULL key counts as an orphan."""
    star = _damaged(spark, folder)
    return dq.orphans(star.fact, star.dims)


_RULES = {
    "null_transaction_ids": "transaction_id IS NULL",
    "negative_sales": "net_sales < 0",
    "units_sold_zero_with_sales": "units_sold = 0 AND net_sales > 0",
    "profit_margin_validation": "profit > net_sales",
    "missing_date_keys": "date_key IS NULL",
}


@query(
    "dq6_row_rules",
    on_short_star(
        DAMAGED
        + _check(
            "row_rule",
            dq.FACT_NAME,
            {n: f"SELECT count(*) AS v FROM damaged WHERE {c}" for n, c in _RULES.items()},
            "warn",
        )
    ),
)
def dq6(spark, folder):
    return dq.row_rules(_damaged(spark, folder).fact)


RECONCILED = """
SELECT 'monthly_sales' AS name, CAST(sum(f.net_sales) AS DOUBLE) AS fact_total,
  CAST(sum(f.net_sales) FILTER (WHERE NOT has_missing_keys) AS DOUBLE) AS report_total,
  CAST(abs(sum(f.net_sales) - sum(f.net_sales) FILTER (WHERE NOT has_missing_keys)) AS DOUBLE) AS difference
FROM fact f
UNION ALL SELECT 'product_profit', CAST(sum(f.profit) AS DOUBLE),
  CAST(sum(f.profit) FILTER (WHERE NOT has_missing_keys) AS DOUBLE),
  CAST(abs(sum(f.profit) - sum(f.profit) FILTER (WHERE NOT has_missing_keys)) AS DOUBLE) FROM fact f
UNION ALL SELECT 'segment_sales', CAST(sum(f.net_sales) AS DOUBLE),
  CAST(sum(f.net_sales) FILTER (WHERE NOT has_missing_keys) AS DOUBLE),
  CAST(abs(sum(f.net_sales) - sum(f.net_sales) FILTER (WHERE NOT has_missing_keys)) AS DOUBLE) FROM fact f"""


@query("dq7_reconciliation", on_short_star(RECONCILED))
def dq7(spark, folder):
    """Reports leave quarantined rows out, so they differ from the whole fact by exactly those."""
    star = ctx.short_star(spark, folder)
    return dq.reconciliation(star.fact, _stored_reports(spark, folder, ctx.short_star))


def _dashboard_sql() -> str:
    dims = {
        "dim_date": "date_key", "dim_product": "product_key", "dim_segment": "segment_key",
        "dim_geography": "geography_key", "dim_discount": "discount_key",
    }
    good = "CASE WHEN {v} = 0 THEN 'Good' ELSE '{bad}' END"
    rows = []

    def row(category, name, value, kind, status, source):
        rows.append(
            f"SELECT '{category}' AS category, '{name}' AS metric_name, CAST({value} AS VARCHAR) AS metric_value, "
            f"'{kind}' AS metric_type, {status} AS status FROM {source}"
        )

    for table, key in dims.items():
        source = (
            f"(SELECT count(*) AS n, "
            + ("0 AS nulls, 0 AS copies" if table == "dim_date" else
               f"count(*) - count({key}) AS nulls, count(*) - count(DISTINCT {key}) AS copies")
            + f" FROM {table})"
        )
        area = "Dimension Tables"
        row(area, table, "n", "Count", "CASE WHEN n > 0 THEN 'Good' ELSE 'Error' END", source)
        row(area, f"{table} - Null Keys", "nulls", "Count", good.format(v="nulls", bad="Error"), source)
        row(area, f"{table} - Duplicate Keys", "copies", "Count", good.format(v="copies", bad="Error"), source)
    area, f = "Fact Table", dq.FACT_NAME
    row(area, f, "n", "Count", "CASE WHEN n > 0 THEN 'Good' ELSE 'Error' END", "metrics")
    row(area, f"{f} - Null Keys", "nulls", "Count", good.format(v="nulls", bad="Error"), "metrics")
    row(area, f"{f} - Duplicate Keys", "copies", "Count", good.format(v="copies", bad="Error"), "metrics")
    share = "CASE WHEN {v} = 0 THEN 'Good' WHEN {v} < n * {s} THEN 'Warning' ELSE 'Error' END"
    row(area, f"{f} - Records With Missing Keys", "missing", "Count", share.format(v="missing", s="0.01"), "metrics")
    row(area, f"{f} - Negative Sales", "neg_sales", "Count", good.format(v="neg_sales", bad="Warning"), "metrics")
    row(area, f"{f} - Negative Profit", "neg_profit", "Count", share.format(v="neg_profit", s="0.05"), "metrics")
    row(area, f"{f} - Inconsistent Units", "odd_units", "Count", good.format(v="odd_units", bad="Warning"), "metrics")
    for table, key in dims.items():
        source = f"(SELECT count(*) AS v FROM fact f LEFT JOIN {table} d ON f.{key} = d.{key} WHERE d.{key} IS NULL)"
        name = key.replace("_key", "_dimension")
        row("Referential Integrity", name, "v", "Orphaned Records", good.format(v="v", bad="Error"), source)
    for name, column in (("monthly_sales", "net_sales"), ("product_profit", "profit"), ("segment_sales", "net_sales")):
        source = (
            f"(SELECT CAST(abs(sum({column}) - sum({column}) FILTER (WHERE NOT has_missing_keys)) "
            f"AS DECIMAL(38,2)) AS v FROM fact)"
        )
        status = "CASE WHEN v < 1 THEN 'Consistent' ELSE 'Inconsistent' END"
        row("Analytical Consistency", f"{name}_vs_fact", "v", "Difference", status, source)
    metrics = (
        ", metrics AS (SELECT count(*) AS n, count(*) - count(transaction_id) AS nulls, "
        "count(*) - count(DISTINCT transaction_id) AS copies, "
        "count(*) FILTER (WHERE has_missing_keys) AS missing, count(*) FILTER (WHERE net_sales < 0) AS neg_sales, "
        "count(*) FILTER (WHERE profit < 0) AS neg_profit, "
        "count(*) FILTER (WHERE units_sold <= 0 AND net_sales > 0) AS odd_units FROM fact)\n"
    )
    icons = "CASE status WHEN 'Good' THEN '✅' WHEN 'Warning' THEN '⚠️' WHEN 'Error' THEN '❌' ELSE '❓' END"
    return metrics + f"SELECT *, {icons} AS status_icon FROM ({' UNION ALL '.join(rows)})"


@query("dq8_quality_dashboard", on_star(_dashboard_sql()))
def dq8(spark, folder):
    star = ctx.star(spark, folder)
    return dq.data_quality_dashboard(star, _stored_reports(spark, folder, ctx.star))


@query("dq8_quality_dashboard_with_quarantine", on_short_star(_dashboard_sql()))
def dq8_short(spark, folder):
    """The dashboard over a fact with quarantined rows: warnings, orphans, inconsistencies."""
    star = ctx.short_star(spark, folder)
    return dq.data_quality_dashboard(star, _stored_reports(spark, folder, ctx.short_star))


@query(
    "dq9_threshold_status",
    on_short_star(
        "SELECT segment_key, CASE WHEN m = 0 THEN 'Good' WHEN m < n * 0.25 THEN 'Warning' ELSE 'Error' END "
        "AS missing_status, CASE WHEN p = 0 THEN 'Good' WHEN p < n * 0.05 THEN 'Warning' ELSE 'Error' END "
        "AS loss_status FROM (SELECT segment_key, count(*) AS n, count(*) FILTER (WHERE has_missing_keys) AS m, "
        "count(*) FILTER (WHERE profit < 0) AS p FROM fact GROUP BY 1)"
    ),
)
def dq9(spark, folder):
    """Status by share of rows, per segment."""
    counts = ctx.short_star(spark, folder).fact.groupBy("segment_key").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("has_missing_keys")).alias("m"),
        F.count_if(F.col("profit") < 0).alias("p"),
    )
    return counts.select(
        "segment_key",
        dq.share_status(F.col("m"), F.col("n"), "0.25").alias("missing_status"),
        dq.share_status(F.col("p"), F.col("n"), "0.05").alias("loss_status"),
    )


@query(
    "dq10_quarantine",
    on_short_star(
        f""", r AS (SELECT d.year, {sums('f.')} FROM clean f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1),
a AS (SELECT CAST(year(transaction_date) AS INTEGER) AS year, count(*) AS fact_rows,
  count(*) FILTER (WHERE has_missing_keys) AS quarantined FROM fact GROUP BY 1)
SELECT a.year, a.fact_rows, a.quarantined, CAST(r.net_sales AS DOUBLE) AS reported_sales
FROM a LEFT JOIN r ON a.year = r.year"""
    ),
)
def dq10(spark, folder):
    """Unresolved rows stay in the fact and out of the reports."""
    star = ctx.short_star(spark, folder)
    rows = star.fact.groupBy(F.col("sale_year").alias("year")).agg(
        F.count("*").alias("fact_rows"), F.count_if(F.col("has_missing_keys")).alias("quarantined")
    )
    report = ctx.stored_report(spark, folder, "monthly_sales_analysis", ctx.short_star)
    sales = report.groupBy("year").agg(F.sum("net_sales").alias("reported_sales"))
    return rows.join(sales, "year", "left")


def every_check() -> str:
    """SQL for all 61 checks."""
    named = {t: dq.FACT_NAME if t == "fact" else t for t in _TABLES}
    sides = {k: "dim_segment" if d == "fewer_segments" else d for k, d in _SIDES.items()}

    def unmatched(condition: str = "") -> dict[str, str]:
        return {
            k: f"SELECT count(*) AS v FROM fact f LEFT JOIN {d} d ON f.{k} = d.{k} WHERE d.{k} IS NULL "
            + condition.format(k=k)
            for k, d in sides.items()
        }

    parts = [_check("not_null", n, _nulls(dq.NOT_NULL[n], t)) for t, n in named.items()]
    parts += [_check("unique", n, _repeats(dq.UNIQUE[n], t)) for t, n in named.items()]
    parts.append(_check("relationships", dq.FACT_NAME, unmatched("AND f.{k} IS NOT NULL")))
    empty = "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS v FROM "
    parts += [_check("non_empty", n, {"*": empty + t}) for t, n in named.items()]
    parts += [_check("non_empty", r, {"*": empty + "clean"}) for r in REPORTS]
    parts.append(_check("referential_integrity", dq.FACT_NAME, unmatched()))
    rules = {n: f"SELECT count(*) AS v FROM fact WHERE {c}" for n, c in _RULES.items()}
    parts.append(_check("row_rule", dq.FACT_NAME, rules, "warn"))
    totals = {f"{n}_totals_match_fact": total for n, (total, _, _) in dq.RECONCILED.items()}
    off = "coalesce(abs(sum({c}) - sum({c}) FILTER (WHERE NOT has_missing_keys)) > 1, true)"
    recon = {n: f"SELECT CAST({off.format(c=c)} AS INTEGER) AS v FROM fact" for n, c in totals.items()}
    parts.append(_check("reconciliation", dq.FACT_NAME, recon))
    return " UNION ALL ".join(parts)


@query(
    "dq11_verdict",
    on_star(
        f""", checks AS ({every_check()})
SELECT bool_and(status <> 'fail') AS passed, count(*) AS checks, count(*) FILTER (WHERE status = 'fail') AS failed,
  count(*) FILTER (WHERE status = 'warn') AS warned FROM checks"""
    ),
)
def dq11(spark, folder):
    """All declared and end-to-end checks, and their verdict."""
    star = ctx.star(spark, folder)
    return dq.verdict(dq.run_checks(star, _stored_reports(spark, folder, ctx.star)))

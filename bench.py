"""Headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` threads; prints one JSON line.

The warehouse is built first and timed as ``warehouse_build``; star queries and
reports then read the stored tables, as the published figures do.  Each query
runs three times after one warm-up run and its median is reported.  A merge of
one id in 256 into a bucketed copy of the fact is timed as
``merge_by_file``; ``merge`` tells how many files it rewrote of how many.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import functions as F

from salesloom import registry
from salesloom.operators.facts import deduplicate
from salesloom.operators.merging import merge_fact, publish_fact
from salesloom.registry import context as ctx
from salesloom.session import build_session, scratch_path
from salesloom.sources import snapshots

HEADLINE = (
    "bq1_fact_totals",
    "bq2_sales_by_month_name",
    "bq3_sales_by_segment_product",
    "bq4_country_sales_in_year",
    "bq5_region_drill_down",
    "bq6_effective_discounts_of_products",
    "bq7_product_segment_profit",
    "bq8_monthly_sales_flat",
    "bq8_monthly_sales_star",
    "bq9_category_sales_flat",
    "bq9_category_sales_star",
    "bq10_country_sales_flat",
    "bq10_country_sales_star",
    "rp1_monthly_sales_analysis",
    "rp2_product_profitability",
    "rp3_segment_performance",
    "rp4_geography_performance",
    "rp5_discount_analysis",
    "rp6_executive_dashboard",
    "dq8_quality_dashboard",
)
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()

    times = {"landing": seconds(lambda: ctx.staged(spark, folder))}
    times["warehouse_build"] = seconds(lambda: ctx.star(spark, folder))
    for name in HEADLINE:
        query = registry.QUERIES[name]

        def run():
            query(spark, folder).collect()

        run()
        times[name] = median(seconds(run) for _ in range(RUNS))
        print(f"{name} {times[name]:.3f}", file=sys.stderr)
    times["inc3_upsert"] = seconds(
        lambda: registry.QUERIES["inc3_upsert"](spark, folder).write.format("noop").mode("overwrite").save()
    )
    fact, path = ctx.star(spark, folder).fact.drop("sale_year"), scratch_path(spark, "bucketed")
    before = publish_fact(fact, path, buckets=16)
    updates = deduplicate(fact.where(F.col("transaction_id").startswith("07")), "latest")
    times["merge_by_file"] = seconds(lambda: merge_fact(spark, path, updates, "latest"))
    merged = snapshots.opened(spark, path)
    result = {
        "metric": "total of headline query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": os.path.basename(folder.rstrip("/")),
        "merge": {"files": len(before.files(spark)), "rewritten": merged.stamps["rewritten"]},
        "fact_rows": ctx.star(spark, folder).fact.count(),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

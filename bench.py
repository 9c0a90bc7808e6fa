"""Time the headline queries on the driver's tables and print one JSON line.

Staged tables are built first and timed on their own (`stage_*`), so that no query hides that work.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallysieve.querybook import all_queries  # noqa: E402
from tallysieve.querybook.world import world  # noqa: E402

HEADLINE = (
    "c07_normalise_vendas", "r05_duplicate_venda_id", "r14_orphan_veiculo_id", "r19_consultor_loja_mismatch",
    "r20_veiculo_multiple_sales", "e01_join_vehicle", "g01_mark_repeated", "g02_mark_later", "g03_first_per_key",
    "f01_monthly_mart", "f04_overall_metrics", "f05_kpis", "f06_monthly_series", "f09_by_channel", "f11_volumes",
    "f13_quality_report", "f15_reconcile", "d05_text_search", "d09_filter_options", "h01_top_brands",
    "h02_investigation_sort", "l04_explore_investigation",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tallysieve-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    w = world(spark, sf)
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("warm_up", lambda: spark.range(1000).selectExpr("sum(id)").collect())
    timed("stage_clean", w.tables)
    timed("stage_flagged", w.evaluation)
    timed("stage_fact", lambda: w.fact)
    timed("stage_report", lambda: w.report)
    queries = all_queries()
    for name in HEADLINE:
        timed(name, lambda name=name: queries[name](spark, sf).write.format("noop").mode("overwrite").save())
    total = round(sum(v for k, v in seconds.items() if k != "warm_up"), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()

"""Times the headline queries; prints one JSON line.

Each query is planned and run whole (``noop`` sink), twice unless it is a long one:
``first`` holds the first time in a running session, ``queries`` the better of the
two. ``start`` is session start and one query together.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from noticelake.registry.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Seconds from which a query is not run a second time.
LONG = 10.0

HEADLINE = (
    "silver_view", "classify_ramo", "classify_documents", "bucketize_valor",
    "range_lexicographic", "regex_ci_unicode", "pages_explode", "bronze_flatten", "missing_pages",
    "bronze_period", "silver_period",
    "dedupe_keep_last", "dedupe_by_customer", "merge_last_fields",
    "upsert_rows", "upsert_field_merge", "upsert_counts", "key_uniqueness", "table_upsert_rows",
    "gold_area", "gold_estado", "gold_faixa", "gold_situacao", "gold_por_mes",
    "gold_grouping_sets", "gold_sliding_periods", "daily_run_situacao",
    "tool_contar", "tool_resumo_estado", "tool_resumo_ramo", "tool_evolucao_mensal", "tool_buscar", "tool_top_orgaos", "tool_estatisticas",
    "to_json_rows", "acc_ti_acima_80k", "acc_compare_region",
    "stream_dedup", "stream_sliding", "stream_upsert",
)


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_twice(spark: SparkSession, name: str) -> list[float]:
    first = run(spark, name)
    return [first] if first >= LONG else [first, run(spark, name)]


def main() -> None:
    start = time.perf_counter()
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("noticelake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "tool_resumo_ramo_uf")
    cold = time.perf_counter() - start

    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    times = {name: run_twice(spark, name) for name in names}
    seconds = {name: round(min(t), 3) for name, t in times.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first": {name: round(t[0], 3) for name, t in times.items()},
                "start": round(cold, 3),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries: one warm-up, then the median of ``BENCH_RUNS`` runs each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sparkloom import get_session
from sparkloom.catalog import QUERIES, load_all

HEADLINE = [
    "src4_nested_feed", "prj14_arithmetic", "flt14_keep_groups", "nul3_fill_statistic", "nul4_fill_ordered",
    "nul5_interpolate_linear", "dup3_run_starts", "jn3_star_join", "jn8_above_group_mean", "jn9_home_away_pairs",
    "agg4_function_map", "agg6_customer_summary", "agg7_union_of_channels", "agg8_quantiles", "agg9_describe",
    "pvt1_pivot_table", "pvt4_crosstab_totals", "win1_latest_per_key", "win2_ranks", "win4_running_others",
    "win8_rolling_mean", "win13_top_shared_ranks", "bin2_quantile_cut", "bin4_keep_top", "ts1_resample",
    "ts5_rolling_daily_mean", "inc3_snapshot", "stm2_tumbling_window", "ml1_feature_build", "ml17_simple_regression",
    "ml8_classifiers", "ml10_nearest_neighbours", "ml16_text_forest", "lin2_upstream_closure", "stm5_append_micro_batches",
    "vec1_nearest", "vec3_sentence_vectors", "srch1_inverted_index", "rule1_discounts", "mdl_fct_customer_orders",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    load_all()
    spark = get_session(f"local[{cpus}]", app="bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        run(spark, name, folder)
        timings[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 4)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.registry import registered
from millrace.session import build_session

HEADLINE = [
    "src2_read_parquet", "flt2_filter_over_join", "str4_parse_access_log", "join2_composite_key", "join5_theta_band_pairs",
    "agg2_word_count", "agg5_log_rollup", "agg8_skewed_group_by", "agg17_count_min_sketch", "agg18_heavy_hitters",
    "srt4_zip_with_index", "srt6_top_k_per_group", "srt7_carry_forward", "dir3_loop_summary", "gra2_pagerank_links",
    "gra3_pagerank_static", "gra4_transitive_closure", "gra5_connected_components", "gra6_triangle_count",
    "cls1_logistic_gradient_descent", "cls7_decision_tree", "cls8_random_forest", "cls9_gradient_boosted_trees",
    "cls11_one_vs_rest", "cls12_knn", "reg1_linear_regression", "clu1_kmeans_lloyd", "clu6_lda_online", "lin1_column_cosines",
    "eva1_curve_areas", "prj4_line_length", "stm6_grep_count", "stm7_running_count", "stm9_sliding_count",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    every = registered()
    names = HEADLINE if not chosen else list(every) if chosen == "all" else chosen.split(",")
    spark = build_session(f"local[{cpus}]", "bench", partitions=cpus, spark__driver__memory="8g", spark__ui__enabled="false")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        every[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

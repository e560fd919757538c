"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then the median of
``$BENCH_RUNS`` (default 3) timed runs.  A run builds the query and drives
it to completion through the ``noop`` sink (full execution, no collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablework.plans import QUERIES  # noqa: E402
from tablework.session import get_session  # noqa: E402

HEADLINE = [
    "word_count", "top_words", "scan_parquet", "join_inner", "join_broadcast", "join_composite",
    "reduce_by_key", "agg_stats", "group_count_2", "crosstab", "pivot_mean", "agg_count_distinct",
    "sort_value", "top_k", "set_subtract", "group_lists", "cogroup_lists", "category_index",
    "kfold_slices", "leave_n_out", "grouped_map_center", "pandas_udf_scalar",
    "stream_watermark_count", "stream_running_count", "graph_pagerank", "graph_cc",
    "ft_tf_idf", "eval_regression", "csc_layout",
]


def run_once(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="tablework-bench")
    out = {}
    for n in names:
        run_once(spark, n, sf)  # warm-up
        out[n] = round(statistics.median(run_once(spark, n, sf) for _ in range(runs)), 3)
    sf_label = sf.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf_value = float(sf_label)
    except ValueError:
        sf_value = sf
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf_value, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

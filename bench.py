"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR``  folder of the tables (default /root/testdata/sf0.1)
``BENCH_CPUS``    local cores (default 8)
``BENCH_RUNS``    timed runs per query after one warm-up (default 3); the median counts
``BENCH_KEYS``    comma-separated keys, or ``all`` (default: the headline list)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assayline import session  # noqa: E402
from assayline.registered import QUERIES  # noqa: E402

HEADLINE = (
    # questions
    "exceeding_rate", "count_by_country", "mycotoxin_counts", "two_country_compare", "samples_per_total_count",
    # reports
    "param_totals", "category_summary", "top_params_per_type", "product_grouping_sets", "strategy_grouping_sets",
    "top_country_strategy_mix", "country_type_matrix", "origin_destination", "trade_routes",
    # joins, reshaping, duplicates
    "sample_measurement_view", "measurement_rest_unpivot", "reconstruct_wide", "duplicate_rows", "measurement_numbers",
    # loads
    "sample_table_load", "measurement_split", "measurement_insert", "amr_load",
)
# Loads are also reported as input rows per second: key -> table that is read.
LOADS = {"sample_table_load": "lineitem", "measurement_split": "lineitem", "measurement_insert": "lineitem"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_KEYS", "")
    keys = list(QUERIES) if wanted == "all" else (wanted.split(",") if wanted else list(HEADLINE))

    spark = session.build("assayline-bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(key: str) -> float:
        with session.scratch_run(spark):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for key in keys:
        run(key)
        seconds[key] = round(statistics.median(run(key) for _ in range(runs)), 4)
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)

    rates = {k: round(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() / seconds[k]) for k, t in LOADS.items() if k in seconds}
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_median_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": float(scale.group(1)) if scale else sf_dir,
        "spark": spark.version,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

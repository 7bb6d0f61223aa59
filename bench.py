"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_REPEAT`` the
runs per query (the fastest counts). Every query is computed in full into Spark's
no-op sink, so no time goes into moving rows to Python. Building the DataFrame is
part of the time, because some operators write intermediate tables while building.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # the reference's own SQL
    "dataset_profiles", "top_config_profile", "space_optimizer_summary", "space_summary", "space_by_accuracy",
    "batch_size_summary", "optimizer_summary", "lr_band_summary", "dataset_distribution", "runs_per_space",
    # sources and sinks
    "scan_runs", "write_runs", "scan_runs_csv", "flatten_nested_runs", "search_runs",
    # recommender
    "nearest_profiles", "recommend_configs", "hit_rate",
    # features and models
    "feature_matrix", "encode_alphabetical", "surrogate_quality", "hp_importance", "space_surrogates", "profile_pca",
    # search and running values
    "accuracy_heatmap", "best_so_far", "trials_to_target", "top_runs_per_space", "warm_start_pool",
    "density_ratio_rank", "elite_profile", "compare_methods", "transfer_gain", "live_progress",
]


def main() -> None:
    from runscope.plans.queries import registered
    from runscope.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "runscope-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()

    queries, seconds = registered(), {}
    for name in chosen:
        runs = []
        for _ in range(repeat):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": f"total of {len(chosen)} queries, fastest of {repeat} runs each, full result to no-op sink",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

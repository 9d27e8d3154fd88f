"""Time the headline queries and print one JSON line.

Every query runs twice, but for the long searches and fits, which run once. The faster time counts, and
all are reported; they cover fitting, intermediate tables and the whole result. What a run
leaves in the scratch folder is deleted after it. BENCH_SF_DIR is the table folder, BENCH_CPUS the number
of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabkit.catalog import QUERIES  # noqa: E402
from tabkit.runtime import scratch_scope  # noqa: E402

RUNS = 2
ONCE = {"gbt_cv", "feature_importance", "score_submission", "leafwise_submission"}
HEADLINE = [
    "group_sum_composite",
    "group_count_mean",
    "collect_by_key",
    "crosstab_segment",
    "profile_columns",
    "mode_per_column",
    "word_counts",
    "except_rows",
    "top_k_ranked",
    "global_rank",
    "global_rank_copies",
    "secondary_sort",
    "lookup_join_orders",
    "lookup_join_shuffled",
    "encode_shuffled",
    "top_k_ties",
    "crosstab_wide",
    "ratio_features",
    "date_features",
    "cross_features",
    "mode_impute_unseen",
    "target_mean_encode",
    "index_categories",
    "standardize",
    "one_hot",
    "tokenize_hash",
    "text_classify",
    "csv_roundtrip",
    "partition_by_mod",
    "feature_importance",
    "score_submission",
    "gbt_cv",
    "leafwise_trees",
    "leafwise_submission",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    # one unmeasured run starts the JVM's code paths
    QUERIES["group_sum_composite"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, every = {}, {}
    for name in chosen:
        every[name] = []
        for _ in range(1 if name in ONCE else RUNS):
            start = time.perf_counter()
            with scratch_scope(spark):
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                every[name].append(round(time.perf_counter() - start, 3))
        seconds[name] = min(every[name])
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "runs": every,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the operators on generated rows of which a third share one key.

    python tests/skew_trial.py [millions of rows]
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabkit.operators import aggregate, joins, layout, order, shape  # noqa: E402
from tabkit.operators.categories import TargetMeanEncoder  # noqa: E402
from tabkit.runtime import materialize  # noqa: E402


def main() -> None:
    rows = int(float(sys.argv[1]) * 1_000_000) if len(sys.argv) > 1 else 20_000_000
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 2654435761 % (rows // 4))
    facts = materialize(spark.range(0, rows, 1, 32).select("id", key.alias("k"), (F.col("id") * 48271 % 1000).alias("v")), "trial")
    dim = spark.range(0, rows // 4, 1, 32).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))
    text = facts.select(F.col("k").cast("string").alias("k"), F.col("v").cast("string").alias("v"), "id")
    trials = {
        "plain sort": lambda: facts.orderBy("k", "id"),
        "global_rank, unique": lambda: order.global_rank(facts, ["k"], ["id"]),
        "global_rank, copies": lambda: order.global_rank(facts.select("k", "v"), ["k"]),
        "plain join": lambda: facts.join(dim, "k", "left"),
        "lookup_join, large": lambda: joins.lookup_join(facts, dim, "k"),
        "collect_by_key": lambda: aggregate.collect_by_key(facts, "k", "v", 10_000),
        "plain except": lambda: facts.select("k").subtract(dim.filter("k % 2 = 0").select("k")),
        "subtract": lambda: shape.subtract(facts.select("k"), dim.filter("k % 2 = 0").select("k")),
        "target means": lambda: TargetMeanEncoder(["k", "v"], "id").fit(text).transform(text),
        "partition_by_mod": lambda: layout.partition_by_mod(facts, "k", 10, splits=14),
    }
    for name, trial in trials.items():
        start = time.time()
        trial().write.format("noop").mode("overwrite").save()
        print(f"{name:22}{time.time() - start:7.1f}s", flush=True)


if __name__ == "__main__":
    main()

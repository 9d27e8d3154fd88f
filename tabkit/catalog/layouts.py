"""J1-J4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import layout


@query("""
SELECT CAST(o_orderkey % 10 AS BIGINT) AS part, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi
FROM orders GROUP BY 1
""")
def partition_by_mod(t: Tables) -> DataFrame:
    placed = layout.partition_by_mod(t("orders").select("o_orderkey"), "o_orderkey", 10)
    return placed.groupBy(F.spark_partition_id().cast("long").alias("part")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")
    )


@query("""
SELECT CAST(o_orderkey % 10 AS BIGINT) AS part, count(*) AS n, CAST(3 AS BIGINT) AS pieces
FROM orders GROUP BY 1
""")
def partition_splits(t: Tables) -> DataFrame:
    placed = layout.partition_by_mod(t("orders").select("o_orderkey"), "o_orderkey", 10, splits=3)
    pieces = layout.partition_profile(placed)
    return pieces.groupBy(F.floor(F.col("partition") / 3).alias("part")).agg(
        F.sum("rows").alias("n"), F.count("*").alias("pieces")
    )


@query("SELECT CAST(10 AS BIGINT) AS partitions, count(*) AS n FROM orders")
def partition_sizes(t: Tables) -> DataFrame:
    sizes = layout.partition_profile(t("orders").repartition(10))
    return sizes.agg(F.count("*").alias("partitions"), F.sum("rows").alias("n"))

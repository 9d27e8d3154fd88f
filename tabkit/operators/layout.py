"""Where rows live: keyed partitions, partition counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.runtime import materialize


def partition_number(key: Column, n: int) -> Column:
    """``key mod n``, never negative."""
    return F.pmod(key, F.lit(n)).cast("int")


def partition_by_mod(df: DataFrame, key: str, n: int, splits: int = 1) -> DataFrame:
    """Move every row to the partition of ``key mod n``.

    With ``splits`` row group ``p`` is spread evenly over the partitions ``p * splits`` to
    ``(p + 1) * splits - 1``, copies of one row included; the rows are written once for that.
    """
    number = partition_number(F.col(key), n)
    if splits == 1:
        return df.repartitionById(n, number)
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    place = number * splits + F.pmod("__row", F.lit(splits)).cast("int")
    return rows.withColumn("__place", place).repartitionById(n * splits, F.col("__place")).drop("__place", "__row")


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition. Empty partitions have no row."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))

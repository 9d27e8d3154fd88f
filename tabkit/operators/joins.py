"""Lookup joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.runtime import DEFAULT_LIMITS, Limits, fits_broadcast, materialize

# A key with more than this share of the rows is hot, so there are at most 1/HOT_SHARE of them.
HOT_SHARE = 0.001
# Salts hash unevenly into partitions; several per partition even that out.
SALTS_PER_PARTITION = 4
# Rows a task of a shuffled lookup has at most, on average.
MOST_ROWS = 250_000


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    limits: Limits = DEFAULT_LIMITS,
    small: bool | None = None,
    hot: DataFrame | None = None,
    row: str | None = None,
) -> DataFrame:
    """Left outer equi join with a table that has one row per key.

    ``dim`` is measured, unless the caller has done so and says whether it is ``small``. Within
    ``limits`` it is broadcast and ``df`` is not shuffled. Beyond them ``df`` is written once, with the
    number of each row; both sides are shuffled by key, and rows of ``df`` with a hot or null key are
    spread over the partitions by their numbers, copies of one row included; only the ``dim`` rows of
    hot keys are repeated for it. There are as many partitions as keep a task's rows, and so its memory, the same at every size. The ``hot`` keys are looked for unless given; a column ``row`` of
    ``df`` with row numbers saves the writing.

    Measuring evaluates ``dim`` once more; `materialize` one that is costly to derive.
    """
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim, limits) if small is None else small:
        return df.join(F.broadcast(dim), on, "left")

    number = row or "__row"
    if row is None:
        df = materialize(df.withColumn(number, F.monotonically_increasing_id()), "join-rows")
    parts = task_count(df, df.count() + dim.count())
    most = _salts_in_all(df, parts)
    marked = F.broadcast(heavy_keys(df, on, partitions=parts) if hot is None else hot)
    no_key = _no_key(on)
    salt = (
        F.when(no_key, F.pmod(number, F.lit(most)))
        .when(F.col("__salts").isNotNull(), F.pmod(F.col(number), F.col("__salts")))
        .otherwise(F.lit(0))
    )
    mark = F.xxhash64(*on)
    left = df.withColumn("__hot", mark).join(marked, "__hot", "left").withColumn("__salt", salt).drop("__salts", "__hot")
    repeats = F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1)
    right = dim.withColumn("__hot", mark).join(marked, "__hot", "left")
    right = right.withColumn("__salt", F.explode(repeats)).drop("__salts", "__hot")
    keys = [*on, "__salt"]
    out = left.repartition(parts, *keys).join(right.repartition(parts, *keys), keys, "left").drop("__salt")
    return out if row else out.drop(number)


def _no_key(on: list[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in on])


def heavy_keys(
    df: DataFrame, on: list[str], by: str | None = None, share: float = HOT_SHARE, partitions: int | None = None
) -> DataFrame:
    """The non-null keys with at least ``share`` of the rows, and over how many salts to spread each.

    A key of any type is told by its hash: (``__hot``, ``__salts``). One pass with a frequent-items
    sketch, so the keys are not shuffled; with ``by`` there is one sketch, and one total, per value of
    that column. The counts are estimates, and two keys may share a hash: both only steer the layout. A
    key gets salts in proportion to its rows, so that all keys together get no more than there are
    keys here plus `SALTS_PER_PARTITION` per partition, of which there are ``partitions`` or those of a shuffle.
    """
    key = F.when(~_no_key(on), F.xxhash64(*on))
    top = F.call_function("approx_top_k", key, F.lit(int(1 / HOT_SHARE)), F.lit(int(10 / HOT_SHARE)))
    found = (
        df.groupBy(*([by] if by else []))
        .agg(F.count("*").alias("__rows"), top.alias("__top"))
        .select(*([by] if by else []), "__rows", F.inline("__top"))
        .filter((F.col("count") >= F.greatest(F.lit(2), F.col("__rows") * share)) & F.col("item").isNotNull())
    )
    salts = F.ceil(F.col("count") / F.col("__rows") * _salts_in_all(df, partitions)).cast("long").alias("__salts")
    return materialize(found.select(*([by] if by else []), F.col("item").alias("__hot"), salts), "hot-keys")


def task_count(df: DataFrame, rows: int) -> int:
    """Partitions for a shuffle of so many rows, more than usual if there are many: by their number, not by the bytes they are compressed to."""
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, -(-rows // MOST_ROWS))


def _salts_in_all(df: DataFrame, partitions: int | None = None) -> int:
    return SALTS_PER_PARTITION * (partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

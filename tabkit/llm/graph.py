"""Connected components of a link table, as rounds of grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.runtime import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each linked node, as (``node``, ``root``).

    Alternating large-star and small-star rounds: every round points the neighbours of a node to the
    smallest of them, first the larger ones, then the smaller ones. Groups only ever yield a minimum, which
    is combined before the shuffle; a node with very many links is one key of a join, which adaptive execution
    splits. Each round is written to the shared scratch folder, so the lineage stays short. Links may be
    repeated, point either way or to the node itself; null ends are ignored.
    """
    x, y = F.least(a, b), F.greatest(a, b)
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = materialize(edges.select(y.alias("u"), x.alias("v")).distinct(), "links")  # u > v
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "links")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        small = small.union(smallest.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """Differs between two sets of links but for a chance of one in 2^64."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

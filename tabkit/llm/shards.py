"""Byte-balanced shards for indivisible groups by Karmarkar-Karp differencing.

A partial partition is a vector of shard loads. The two with the largest spread are combined again
and again, the fullest shard of one with the emptiest of the other. Tasks do this for blocks of
groups; the resulting load vectors, one per block, are combined in the same way, in tasks as well, until
one block is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabkit.llm.common import BATCH_ROWS, map_arrow
from tabkit.operators.joins import lookup_join
from tabkit.runtime import materialize

# Groups, and vectors of loads, that are differenced together in a task.
BLOCK_GROUPS, BLOCK_VECTORS = 20_000, 5_000
_ROW_BITS = 33


def difference(loads: list[list[int]]) -> list[list[int]]:
    """Karmarkar-Karp over partial partitions.

    ``loads`` holds one vector of shard loads per partial partition, all of one length. Returns
    for each of them, which final shard each of its positions goes to.
    """
    if not loads:
        return []
    k = len(loads[0])
    order = [sorted(range(k), key=lambda i, v=v: -v[i]) for v in loads]
    made: list[tuple[int, int, list[int]]] = []  # (one, other, which sum stands at each place)
    heap = []
    for node, v in enumerate(loads):
        v = [v[i] for i in order[node]]
        heap.append((v[-1] - v[0], node, v))
    heapq.heapify(heap)
    n = len(loads)
    while len(heap) > 1:
        _, a, one = heapq.heappop(heap)
        _, b, other = heap[0]
        sums = [x + y for x, y in zip(one, reversed(other), strict=True)]
        places = sorted(range(k), key=sums.__getitem__, reverse=True)
        v = [sums[i] for i in places]
        heapq.heapreplace(heap, (v[-1] - v[0], n + len(made), v))
        made.append((a, b, places))
    shard: dict[int, list[int]] = {n + len(made) - 1: list(range(k))}
    for node in range(len(made) - 1, -1, -1):
        of = shard.pop(n + node)
        a, b, places = made[node]
        left, right = [0] * k, [0] * k
        for s, i in zip(of, places, strict=True):
            left[i] = s
            right[k - 1 - i] = s
        shard[a], shard[b] = left, right
    out = []
    for node in range(n):
        to = [0] * k
        for place, i in enumerate(order[node]):
            to[i] = shard[node][place]
        out.append(to)
    return out


def _difference_blocks(nodes: DataFrame, shards: int, block: int) -> DataFrame:
    """Difference the load vectors (``key``, ``loads``) in blocks that the hash of the key makes.

    Vectors may be short; what they lack is zero. Returns ``block``, ``key``, ``to`` (where each position
    goes within its block) and ``loads``. A block is read in the order of its vectors and keys, so
    that only they decide.
    """
    kind = nodes.schema["key"].dataType.simpleString()
    schema = f"block long, key {kind}, `to` array<int>, loads array<long>"
    blocks = max(-(-nodes.count() // block), 1)
    placed = nodes.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key", "loads")
    placed = placed.repartition("block").sortWithinPartitions("block", "loads", "key")
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, loads = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            to = difference([v + [0] * (shards - len(v)) for v in loads])
            to = [t[: len(v)] for t, v in zip(to, loads, strict=True)]
            for i in range(0, len(keys), BATCH_ROWS):
                part = slice(i, i + BATCH_ROWS)
                columns = [[now] * len(keys[part]), keys[part], to[part], loads[part]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

        for batch in batches:
            for b, k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != now and keys:
                    yield from done()
                    keys, loads = [], []
                now = b
                keys.append(k)
                loads.append(v)
        if keys:
            yield from done()

    return map_arrow(placed, run, schema)


def assign_groups(
    groups: DataFrame, key: str, size: str, shards: int, block: int = BLOCK_GROUPS, vectors: int = BLOCK_VECTORS
) -> DataFrame:
    """One row per group with its shard (``key``, ``shard``); the groups' sizes decide.

    ``key`` is binary and unique. Groups of one size go by their key, so that the result is the same
    for every partitioning of the same groups. About ``block`` groups are differenced in a task; the
    vectors of loads that come of it again, ``vectors`` at a time, until one task holds the rest.
    """
    if vectors < 2:
        raise ValueError("fewer than two vectors cannot be combined")
    level = groups.select(F.col(key).alias("key"), F.array(F.col(size).cast("long")).alias("loads"))
    made, limit = [], block
    while True:
        level = materialize(_difference_blocks(level, shards, limit), "shard-blocks")
        made.append(level)
        if level.select("block").distinct().count() < 2:
            break
        # the load of place p of a block: what its vectors send there
        sent = [F.get("loads", F.array_position("to", F.lit(p)).cast("int") - 1) for p in range(shards)]
        sums = F.array(*(F.coalesce(F.sum(x), F.lit(0).cast("long")) for x in sent))
        level = level.groupBy(F.col("block").alias("key")).agg(sums.alias("loads"))
        limit = vectors
    final = made.pop().select("key", "to")
    while made:
        # one row per block: `lookup_join` measures them before it broadcasts them
        above = final.select(F.col("key").alias("block"), F.col("to").alias("__above"))
        below = lookup_join(made.pop().select("block", "key", "to"), above, "block")
        final = below.select("key", F.transform("to", lambda p: F.get("__above", p)).alias("to"))
    return final.select(F.col("key").alias(key), F.get("to", F.lit(0)).alias("shard"))


def shard_by_bytes(df: DataFrame, shards: int = 16, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards of nearly equal bytes; equal texts stay together.

    Returns ``row_id``, ``size`` (bytes of the text plus one; null counts as empty), ``text_crc32``,
    ``text_key`` (SHA-256), ``shard`` and ``slot`` (0, 1, ... within the shard in the order of the
    id, nulls first). Groups of equal bytes go by the SHA-256, so the shards depend on the texts and their
    copies alone. A group larger than a fair share fills a shard alone. Repeated rows are one
    group, each with a slot of its own. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(row_id),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("text_key"),
    )
    rows = materialize(rows, "shard-rows")
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    # a text with very many copies is one key: adaptive execution splits its rows in this join
    placed = rows.join(assign_groups(groups, "text_key", "bytes", shards), "text_key")
    order = [F.col("shard"), F.col(row_id), F.col("text_key")]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "shard-order")
    part = F.shiftright("at", _ROW_BITS)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("shard", part.alias("part"))
        .agg(F.min("at").alias("first"), F.count("*").alias("n"))
        .select("shard", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    # one row per partition and shard in it: at most partitions plus shards
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(runs), ["shard", "part"])
        .select(row_id, "size", "text_crc32", "text_key", "shard", (F.col("at") - F.col("first") + F.col("earlier")).alias("slot"))
    )

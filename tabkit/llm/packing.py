"""Packing documents into token sequences by shortest-pack-first over the histogram of lengths.

A document's full sequences stand alone; what is left of it, less than a sequence, goes into the histogram. There
are exactly as many packs as the left-over tokens fill, one per power of two at the end. Lengths are placed
longest first, always into the packs with most space, and whole groups of equal packs at once: a placement says that
the documents of one length with ranks from ``low`` to ``high`` lie, ``copies`` in each, in consecutive
sequences at one offset. Where no pack has enough space for a length, the piece is cut at the largest
space there is and the rest goes back to the histogram as a shorter length. So no sequence needs padding.

The plan depends on the histogram alone, 2,047 counts for sequences of 2,048 tokens, however many documents there are. A
document finds its placements by its length and its rank among the documents of that length.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, make_room, map_arrow
from tabkit.llm.tokens import batch_groups, column, read_text, word_encoder
from tabkit.runtime import fits_broadcast, materialize

SIZE = 2048


@dataclass(frozen=True)
class Placement:
    """Tokens ``start`` to ``start + length`` of what is left of the documents of a length."""

    rest: int  # the documents' length
    low: int  # ranks from here
    high: int  # to before here
    copies: int  # consecutive ranks in one sequence
    start: int
    length: int
    sequence: int  # that of the first rank
    offset: int


def plan(histogram: dict[int, int], size: int = SIZE) -> list[Placement]:
    """Placements of all documents of a histogram of lengths below ``size``, without any padding.

    Every step uses up a group of equal packs or a group of equal pieces, so the plan's length depends on
    the number of lengths, not of documents. Ties go to the packs opened first.
    """
    full, rest = divmod(sum(n * count for n, count in histogram.items()), size)
    # packs as (-space, first sequence, packs, tokens in each)
    packs = [(-size, 0, full, 0)] if full else []
    for bit in reversed(range(size.bit_length())):
        if rest >> bit & 1:
            packs.append((-(1 << bit), full, 1, 0))
            full += 1
    heapq.heapify(packs)
    open_packs = full
    waiting: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # length: (rest, low, high, start)
    for n, count in histogram.items():
        if n and count:
            waiting[n].append((n, 0, count, 0))
    out = []
    for length in range(max(waiting, default=0), 0, -1):
        pieces = waiting.pop(length, [])
        left = sum(high - low for _, low, high, _ in pieces)
        for of, low, high, start in pieces:
            while low < high:
                space, first, count, filled = heapq.heappop(packs)
                space = -space
                if space < length:  # nowhere enough: cut
                    here = space
                    copies, used = 1, min(count, high - low)
                    waiting[length - here].append((of, low, low + used, start + here))
                else:
                    here = length
                    # what every pack will get of this length, at once
                    copies = min(high - low, max(1, min(space // length, left // open_packs)))
                    used = min(count, (high - low) // copies)
                out.append(Placement(of, low, low + used * copies, copies, start, here, first, filled))
                low += used * copies
                left -= used * copies
                if used < count:
                    heapq.heappush(packs, (-space, first + used, count - used, filled))
                if space > copies * here:
                    heapq.heappush(packs, (copies * here - space, first, used, filled + copies * here))
                else:
                    open_packs -= used
    return out


def _tokenized(df: DataFrame, path: str, text: str, end: int, size: int, names: list[str]) -> DataFrame:
    """Add the packed ids, their number, the task's number, and what the task has counted before each row."""
    spec = df.sparkSession.sparkContext.broadcast(read_text(path))
    schema, arrow = extended(
        df, (names[0], T.BinaryType()), (names[1], T.LongType()), (names[2], T.IntegerType()), *((n, T.LongType()) for n in names[3:])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = word_encoder(spec.value), np.array([end], "<u4").tobytes()
        task, chunks = TaskContext.get().partitionId(), 0
        seen: dict[int, int] = defaultdict(int)  # rows so far of each rest
        for group in batch_groups(batches, text):
            found = encoder.encode_array(pa.concat_arrays([column(b, text) for b in group]), last)
            for batch in group:
                ids, found = found[: batch.num_rows], found[batch.num_rows :]
                tokens = (pc.binary_length(ids).to_numpy() // 4).tolist()
                nth, before = [], []
                for n in tokens:
                    nth.append(seen[n % size])
                    before.append(chunks)
                    seen[n % size] += 1
                    chunks += n // size
                tasks = pa.array(np.full(len(ids), task, np.int32))
                yield append(batch, arrow, ids, pa.array(tokens), tasks, pa.array(nth), pa.array(before))

    return map_arrow(df, run, schema)


def _bases(rows: DataFrame, size: int) -> DataFrame:
    """(task, rest, before, chunks): documents of that rest, and full sequences, of the tasks before."""
    before = lambda n, *by: F.coalesce(
        F.sum(n).over(Window.partitionBy(*by).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    counts = rows.groupBy("task", F.pmod("tokens", F.lit(size)).alias("rest")).agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("tokens") / size)).alias("full")
    )
    counts = materialize(counts, "pack-counts")
    # one row per task each: as many as the table has partitions
    tasks = counts.groupBy("task").agg(F.sum("full").alias("full")).withColumn("all", F.lit(0))
    tasks = tasks.select("task", before("full", "all").alias("chunks"))
    return counts.select("task", "rest", "n", before("n", "rest").alias("before")).join(tasks, "task")


def pack(df: DataFrame, path: str, text: str = "text", end: int = 1, size: int = SIZE) -> DataFrame:
    """Pack the tokens of every text, each with the id ``end`` behind, into sequences of at most ``size`` tokens.

    ``path`` is a tokenizer file that the driver can read; its content goes to the tasks. One row per piece: the
    columns of ``df`` without the text, then ``start`` and ``length`` in the document's tokens, ``ids`` (the
    piece's, little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` there. Every token is
    in exactly one piece. Every sequence is full, but for at most one of each smaller power of two, and
    sequence ids have no gaps. Columns with one of these names are replaced.

    A null text is empty and has the id ``end`` alone; long texts are encoded word by word. Rows are told apart by their place,
    so repeated rows and null ids are packed once each; which of several documents of one length goes
    where is a tie that the table's layout decides. An empty table has no pieces.
    """
    if size & (size - 1) or size < 2:
        raise ValueError("a power of two")
    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    keep = [c for c in make_room(df, *names).columns if c != text]
    source = df.select(F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("__")).alias("row"), F.col(text).alias("text"))
    rows = _tokenized(source, path, "text", end, size, ["ids", "tokens", "task", "nth", "chunks_before"]).drop("text")
    rows = materialize(rows, "pack-tokens")
    bases = materialize(_bases(rows, size), "pack-bases")
    counts = bases.groupBy("rest").agg(F.sum("n").alias("n"))
    histogram = {r["rest"]: r["n"] for r in counts.collect()}  # at most ``size`` rows
    chunks = rows.agg(F.sum(F.floor(F.col("tokens") / size))).first()[0] or 0
    return _pieces(rows, bases, plan({k: n for k, n in histogram.items() if k}, size), chunks, size, keep)


def _pieces(rows: DataFrame, bases: DataFrame, placements: list[Placement], chunks: int, size: int, keep: list[str]) -> DataFrame:
    """The written rows with their pieces, by length and rank."""
    fields = "rest long, low long, high long, copies long, start long, length long, sequence long, offset long"
    planned = rows.sparkSession.createDataFrame([astuple(p) for p in placements], fields)
    planned = planned.groupBy("rest").agg(F.collect_list(F.struct(*planned.columns[1:])).alias("places"))

    bases = bases.select("task", "rest", "before", "chunks")
    bases = F.broadcast(bases) if fits_broadcast(bases) else bases
    rows = rows.withColumn("rest", F.pmod("tokens", F.lit(size))).join(bases, ["task", "rest"])
    # the plan's size is bounded by the sequence length alone
    rows = rows.join(F.broadcast(planned), "rest", "left").withColumn("rank", F.col("nth") + F.col("before"))
    full = F.floor(F.col("tokens") / size)

    def piece(start: Column, length: Column, sequence: Column, offset: Column) -> Column:
        ids = F.substring(F.col("ids"), (4 * start + 1).cast("int"), (4 * length).cast("int"))
        return F.struct(
            start.alias("start"), length.alias("length"), ids.alias("ids"), sequence.alias("sequence_id"), offset.alias("offset")
        )

    alone = F.when(full > 0, F.sequence(F.lit(0).cast("long"), full - 1))
    alone = F.transform(
        F.coalesce(alone, F.array().cast("array<long>")),
        lambda k: piece(k * size, F.lit(size).cast("long"), F.col("chunks") + F.col("chunks_before") + k, F.lit(0).cast("long")),
    )
    mine = F.filter(F.col("places"), lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"]))

    def placed(p: Column) -> Column:
        nth = F.col("rank") - p["low"]
        sequence = F.lit(chunks).cast("long") + p["sequence"] + F.floor(nth / p["copies"])
        return piece(full * size + p["start"], p["length"], sequence, p["offset"] + F.pmod(nth, p["copies"]) * p["length"])

    shared = F.when((F.col("rest") > 0) & F.col("places").isNotNull(), F.transform(mine, placed))
    pieces = F.concat(alone, F.coalesce(shared, F.filter(alone, lambda _: F.lit(False))))
    out = rows.select("row", F.col("tokens").alias("doc_tokens"), F.explode(pieces).alias("piece"))
    columns = [F.col("row")[c].alias(c) for c in keep]
    return out.select(*columns, "piece.start", "piece.length", "piece.ids", "doc_tokens", "piece.sequence_id", "piece.offset")

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a point halfway between them. Every distinct fingerprint
emits all variants within half the radius, the variants are shuffled, and fingerprints that meet at a
variant are links. A variant has at most as many fingerprints as there are variants of one, so its
group is bounded however many copies a text has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, fresh, make_room, map_arrow
from tabkit.llm.graph import connected_components
from tabkit.llm.similar import similar_groups
from tabkit.runtime import materialize

SEED = 42
_ROWS = 1 << 16


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``words`` words, joined by blanks; the whole sequence if there are fewer."""
    w = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not w:
        return np.empty(0, np.uint64)
    line = b" ".join(w)
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([digest(line, seed)], np.uint64)
    ends = list(accumulate(len(x) + 1 for x in w))
    starts = [0, *ends]
    return np.array([digest(line[i : j - 1], seed) for i, j in zip(starts, ends[words - 1 :])], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number."""
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _ROWS):
        part = np.ascontiguousarray(hashes[i : i + _ROWS]).view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", words: int = 3, name: str = "fingerprint") -> DataFrame:
    """Add the 64-bit SimHash of the whole text as a signed long. Null or wordless texts have zero.

    A column called ``name`` already is replaced.
    """
    df = make_room(df, name)
    schema, arrow = extended(df, (name, T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            marks = [majority(shingle_hashes(t, words)) for t in column.to_pylist()]
            yield append(batch, arrow, pa.array(marks, pa.int64()))

    return map_arrow(df, run, schema)


def _masks(bits: int) -> list[int]:
    """All 64-bit masks with at most ``bits`` bits set, as signed numbers."""
    out = [sum(1 << i for i in c) for n in range(bits + 1) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def links(fingerprints: DataFrame, radius: int = 2, name: str = "fingerprint") -> DataFrame:
    """Links (``a``, ``b``, ``bits``) between distinct fingerprints at most ``radius`` bits apart.

    Not every such pair is returned, but enough that the components are those of all pairs: each
    variant links its smallest fingerprint to all others that meet there.
    """
    near, far = radius // 2, (radius + 1) // 2
    masks = _masks(far)
    distinct = fingerprints.select(F.col(name).alias("b")).distinct()
    variants = distinct.select("b", F.explode(F.array(*map(F.lit, masks))).alias("mask")).select(
        F.col("b").bitwiseXOR(F.col("mask").cast("long")).alias("variant"), "b"
    )
    close = F.bit_count(F.col("b").bitwiseXOR(F.col("variant"))) <= near
    meet = F.min(F.when(close, F.col("b"))).over(Window.partitionBy("variant"))
    pairs = variants.select("b", meet.alias("a")).filter("a <> b").distinct()
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.select("a", "b", bits.alias("bits")).filter(F.col("bits") <= radius)


def near_duplicates(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """One row per row of ``df``: its id, ``fingerprint`` (signed long) and ``component_id``.

    The component is that of the graph that links fingerprints at most ``radius`` bits apart, named
    by its smallest id (null ids name one only if there is no other). Equal texts, null and wordless
    ones included, have equal fingerprints and so one component. Repeated rows come out as often.
    """
    rows = with_fingerprint(df.select(F.col(row_id).alias("id"), F.col(text).alias("text")), "text", words)
    rows = materialize(rows.select("id", "fingerprint"), "simhash")
    return _grouped(rows, radius).withColumnRenamed("id", row_id)


def _grouped(rows: DataFrame, radius: int) -> DataFrame:
    """(id, fingerprint) with the component of each row."""
    firsts = rows.groupBy("fingerprint").agg(F.min("id").alias("first"))
    roots = connected_components(links(rows, radius))
    classes = firsts.join(roots, firsts["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    classes = materialize(classes, "simhash-classes")
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(names, "root").select("fingerprint", "component_id")
    # the fingerprint of very many copies is one key: adaptive execution splits its rows
    return rows.join(classes, "fingerprint").select("id", "fingerprint", "component_id")


# -- similar texts ------------------------------------------------------------------------------

_SEQUENCE = "word_sequence"


def _sequence(text: str | None) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join((text or "").encode().lower().split()), SEED)


def drop_near_duplicates(
    df: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest integer id; columns as they are.

    Texts with equal words, ASCII letters' case aside, are copies. Different ones are linked when the Jaccard
    similarity of their shingles is at least ``similarity``; groups are the components of all such links. Null,
    empty and blank texts are copies of each other. A null id counts as the smallest. An id that several
    different texts have is one of each of them. Rows with the same id and the same words are copies: one
    of them stays. Of texts of a group with the same smallest id, one stays.
    """
    key = F.coalesce(F.col(row_id).cast("long"), F.lit(-(1 << 63)))
    docs = df.select(key.alias("id"), F.col(text).alias("text"))
    texts, groups = similar_groups(docs, _sequence, lambda t: np.unique(shingle_hashes(t, words)).view(np.int64), similarity)
    # of a group the smallest id
    grouped = texts.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = grouped.groupBy("root").agg(F.min(F.struct("id", _SEQUENCE)).alias("first")).select("first.*")

    at, mark = fresh(df, "row_key"), fresh(df, _SEQUENCE)
    schema, arrow = extended(df, (mark, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield append(batch, arrow, pa.array(map(_sequence, texts), pa.binary()))

    marked = map_arrow(df, run, schema).withColumn(at, key)
    chosen = kept.select(F.col("id").alias(at), F.col(_SEQUENCE).alias(mark))
    once = Window.partitionBy(at, mark).orderBy(F.lit(0))
    stay = marked.join(chosen, [at, mark]).withColumn(fresh(df, "row_copy"), F.row_number().over(once))
    return stay.filter(F.col(fresh(df, "row_copy")) == 1).select(*(F.col(f"`{c}`") for c in df.columns))

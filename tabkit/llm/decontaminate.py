"""Benchmark decontamination as a prefix-filtered set join with exact verification.

A window is a number of consecutive words of an item; it counts only where the document holds all of
its words, so the necessary prefix of a window in rarity order is its single rarest word. Documents
are probed with those words alone. The place of the word in the window fixes where the window must
begin (positional bound) and that it must fit into the document (length bound); what is left is
compared word by word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, fresh, make_room, map_arrow

WINDOW = 13
# Bytes of item text whose index goes to the tasks at once. More items make more blocks, which the
# rows pass one after the other in the same stage.
BLOCK_BYTES = 16 << 20

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def words(text: str | None) -> list[bytes]:
    """Runs of digits, lower-cased ASCII letters and all characters beyond ASCII, as UTF-8."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def windows(item: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """All windows of an item; one that is shorter than a window is a window itself."""
    return {tuple(item[i : i + size]) for i in range(max(len(item) - size, 0) + 1)} if item else set()


def _blocks(items: DataFrame, item_id: str, item_text: str, limit: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items in blocks of at most ``limit`` bytes (or one item), streamed to the driver one at a time."""
    block: list[tuple[str | None, str]] = []
    size = 0
    for row in items.select(F.col(item_id).cast("string"), item_text).distinct().toLocalIterator():
        text = row[1] or ""
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    if block:
        yield block


def word_rarity(docs: DataFrame, vocabulary: set[bytes], text: str) -> dict[bytes, int]:
    """In how many documents each of the words is, over all documents."""
    known = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                count.update(known.value.intersection(words(t)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=["word", "n"]
        )

    counts = map_arrow(docs.select(text), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}  # words of one block of items at most


class Index:
    """Windows of a block of items under their rarest word."""

    def __init__(self, items: list[tuple[str | None, str]], size: int, rarity: dict[bytes, int]):
        holders: dict[tuple[bytes, ...], set] = defaultdict(set)
        for item, text in items:
            for window in windows(words(text), size):
                holders[window].add(item)
        self.holders = dict(holders)
        #: rarest word -> the places it has in its windows: (words before it, words in the window)
        self.places: dict[bytes, set[tuple[int, int]]] = defaultdict(set)
        for window in self.holders:
            offset = min(range(len(window)), key=lambda i: (rarity.get(window[i], 0), window[i], i))
            self.places[window[offset]].add((offset, len(window)))
        self.places = dict(self.places)

    def find(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Where windows occur, as (start, stop) in order of start, and the items they come from."""
        places, holders, n = self.places, self.holders, len(text)
        spans, items = set(), set()
        for i in [i for i, w in enumerate(text) if w in places]:
            for offset, size in places[text[i]]:
                start = i - offset
                if start < 0 or start + size > n:
                    continue
                found = holders.get(tuple(text[start : start + size]))
                if found is not None:
                    spans.add((start, start + size))
                    items |= found
        return sorted(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Add to each document which of its words lie in an occurrence of an item's window.

    New columns, under ``prefix``: ``n_words`` (long), ``hit_spans`` (array of start and stop, word
    positions, disjoint, in order), ``n_hit`` (long), ``items`` (ids as strings, sorted), all for the
    whole text. A null text has no words. Null or empty items have no windows; an item with a null
    id marks words but is not listed; repeated items count once by id. Without items nothing is
    hit. Documents are independent, so copies and ties need no special case; all their columns stay,
    but those that have one of the new names.
    """
    names = [prefix + n for n in ("n_words", "hit_spans", "items")]
    docs = make_room(docs, *names, prefix + "n_hit")
    sc = docs.sparkSession.sparkContext
    out, first = docs, True
    for block in _blocks(items, item_id, item_text, block_bytes):
        vocabulary = {w for _, t in block for w in words(t)}
        index = Index(block, window, word_rarity(docs, vocabulary, text))
        out = _probe(out, sc.broadcast(index), text, names, first)
        first = False
    if first:
        out = _probe(out, sc.broadcast(Index([], window, {})), text, names, True)
    spans = F.col(names[1])
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return out.withColumn(prefix + "n_hit", n_hit)


def _probe(df: DataFrame, index, text: str, names: list[str], first: bool) -> DataFrame:
    """Probe all rows with one block's index, adding to what earlier blocks have found."""
    fields = list(zip(names, [T.LongType(), _SPANS, T.ArrayType(T.StringType())], strict=True))
    schema, arrow = extended(df.drop(*names), *fields)
    at = [arrow.get_field_index(n) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
            n_words, spans, items = [], [], []
            known = zip(column(names[1]), column(names[2]), strict=True) if not first else None
            for t in column(text):
                w = words(t)
                s, found = index.value.find(w)
                found = {x for x in found if x is not None}
                if known is not None:
                    old_spans, old_items = next(known)
                    s = [*s, *((x["start"], x["stop"]) for x in old_spans)]
                    found |= set(old_items)
                n_words.append(len(w))
                spans.append([{"start": a, "stop": b} for a, b in merged(s)])
                items.append(sorted(found))
            rest = batch if first else batch.select([c for c in batch.schema.names if c not in names])
            new = [pa.array(v, arrow.field(i).type) for v, i in zip((n_words, spans, items), at, strict=True)]
            yield append(rest, arrow, *new)

    return map_arrow(df, run, schema)


def contaminated(n_hit, n_words):
    """The rule of the benchmark filter: at least a word in twenty is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    prefix = fresh(docs, "hits_")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    found = find_contamination(docs, items, prefix=prefix, **options)
    return found.filter(~contaminated(F.col(prefix + "n_hit"), F.col(prefix + "n_words"))).select(*docs.columns)

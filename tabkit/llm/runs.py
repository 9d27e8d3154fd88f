"""Periodic runs of words by enumerating maximal pairs.

A run is a stretch of words with smallest period q that repeats it often enough and that no neighbouring word
continues. Its first word and the word q further on start a maximal pair: equal stretches that differ in the
word before and in the word after them. So runs are the maximal pairs whose distance is small against their
length, and nothing has to be extended.

Maximal pairs are listed bottom-up in the tree of LCP intervals of a suffix array. Every node keeps its
places by the word on their left; where two children meet, the smaller one's places are looked up among the
others, within the distance that the node's depth allows and only under other left words. The places that an
equal stretch has within a third of its length form one progression, so there are no more pairs than
repetitions.

The array is made of the repeated stretches only: windows as long as the shortest stretch of a pair that
the document does not have twice are in no pair.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, make_room, map_arrow

# Texts are indexed together up to this many bytes; a longer one alone.
SLICE_BYTES = 2 << 20
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Rule:
    """Runs of at least ``least`` words and ``times`` periods, as limits on maximal pairs."""

    def __init__(self, least: int, times: int):
        if times < 2 or least < 1:
            raise ValueError("a run has at least two periods and one word")
        self.least, self.times = least, times
        # the shortest stretch of any pair: least - d words at distance d, and times - 1 periods of it
        self.depth = min(max(least - d, (times - 1) * d) for d in range(1, least + 1))

    def reach(self, depth: int) -> int:
        """The largest distance of a pair of stretches of ``depth`` words."""
        return depth // (self.times - 1)


def _ranks(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _paired(rank: np.ndarray, step: int) -> np.ndarray:
    """Rank of each place together with the place ``step`` further on; past the end is smallest."""
    after = np.zeros(len(rank), np.int64)
    after[: max(len(rank) - step, 0)] = rank[step:] + 1
    return _ranks(rank * (int(rank.max()) + 2) + after)


def _window_ranks(rank: np.ndarray, words: int) -> np.ndarray:
    width = 1
    while 2 * width <= words:
        rank, width = _paired(rank, width), 2 * width
    return _paired(rank, words - width) if words > width else rank


def _suffixes(rank: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``starts`` in suffix order, and how many words each shares with the next.

    Doubling ranks give the order, and read from the widest down the shared lengths as well.
    """
    levels, width = [rank], 1
    while int(rank.max()) + 1 < len(rank):
        rank, width = _paired(rank, width), 2 * width
        levels.append(rank)
    order = starts[np.argsort(rank[starts])]
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for level, r in zip(range(len(levels) - 1, -1, -1), reversed(levels)):
        inside = (a < len(r)) & (b < len(r))
        same = np.zeros(len(a), bool)
        same[inside] = r[a[inside]] == r[b[inside]]
        step = same * (1 << level)
        a, b, shared = a + step, b + step, shared + step
    return order, shared


class _Places:
    """The places below a node: all in order, and by the word on their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all = [place]
        self.by_left = {left: [place]}

    def near(self, place: int, left: int, reach: int, lefts: list[int]) -> Iterator[int]:
        """The places at most ``reach`` away that have another left word."""
        i, j = bisect_left(self.all, place - reach), bisect_right(self.all, place + reach)
        if j - i <= len(self.by_left):
            yield from (p for p in self.all[i:j] if lefts[p] != left)
            return
        for other, places in self.by_left.items():
            if other != left:
                yield from places[bisect_left(places, place - reach) : bisect_right(places, place + reach)]

    def add(self, other: _Places) -> None:
        _merge(self.all, other.all)
        for left, places in other.by_left.items():
            if left in self.by_left:
                _merge(self.by_left[left], places)
            else:
                self.by_left[left] = places


def _merge(into: list[int], more: list[int]) -> None:
    if len(more) <= 4:
        for p in more:
            insort(into, p)
    else:
        into += more
        into.sort()  # two sorted stretches: one pass


def _meet(a: _Places, b: _Places, depth: int, rule: Rule, lefts: list[int], out: list[tuple[int, int, int]]) -> _Places:
    """Pairs between two children of a node of that depth, and the children together."""
    if len(a.all) < len(b.all):
        a, b = b, a
    reach = rule.reach(depth)
    for left, places in b.by_left.items():
        for p in places:
            out += [(min(p, q), max(p, q), depth) for q in a.near(p, left, reach, lefts)]
    a.add(b)
    return a


def _tree_pairs(order: list[int], shared: list[int], rule: Rule, lefts: list[int]) -> list[tuple[int, int, int]]:
    """Maximal pairs (place, place, depth) of suffixes that all share more than the least depth."""
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Places]] = []
    node = _Places(order[0], lefts[order[0]])
    for place, depth in zip([*order[1:], -1], [*shared, 0], strict=True):
        while stack and stack[-1][0] > depth:
            above, places = stack.pop()
            node = _meet(places, node, above, rule, lefts, out)
        if place < 0:
            break
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, _meet(stack[-1][1], node, depth, rule, lefts, out))
        else:
            stack.append((depth, node))
        node = _Places(place, lefts[place])
    return out


def maximal_pairs(words: np.ndarray, bounds: np.ndarray, rule: Rule) -> np.ndarray:
    """Rows (place, place, words shared) of the maximal pairs that ``rule`` allows.

    ``words`` numbers the words of several documents in a row; document i has ``bounds[i]:bounds[i + 1]``.
    """
    none = np.empty((0, 3), np.int64)
    if not len(words):
        return none
    # a place of its own behind every document, and no word in two documents
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = doc * (int(words.max()) + 1) + words
    at = np.arange(len(words)) + doc
    text = np.full(len(words) + len(bounds) - 1, -1, np.int64)
    text[at] = key
    ends = np.flatnonzero(text < 0)
    text[ends] = int(key.max()) + 1 + np.arange(len(ends))
    window = _window_ranks(_ranks(text), rule.depth)
    twice = np.flatnonzero(np.bincount(window)[window] > 1)
    if not len(twice):
        return none

    # the repeated stretches in a row, each with an end of its own
    covered = np.zeros(len(text) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + rule.depth, -1)
    inside = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
    stretch = np.cumsum(np.concatenate(([0], (np.diff(inside) > 1).astype(np.int64))))
    small = np.full(len(inside) + int(stretch[-1]) + 1, -1, np.int64)
    small[np.arange(len(inside)) + stretch] = text[inside]
    breaks = np.flatnonzero(small < 0)
    small[breaks] = int(text.max()) + 1 + np.arange(len(breaks))
    where = np.zeros(len(small), np.int64)
    where[np.arange(len(inside)) + stretch] = inside
    starts = (np.arange(len(inside)) + stretch)[np.searchsorted(inside, twice)]
    order, shared = _suffixes(_ranks(small), starts)

    left = np.full(len(text), -1, np.int64)  # the first place of a document has no word on its left
    left[1:] = np.where(np.isin(np.arange(len(text) - 1), ends), -1, text[:-1])
    place = where[order]
    cuts = np.flatnonzero(shared < rule.depth) + 1
    sizes = np.diff(np.concatenate(([0], cuts, [len(place)])))
    firsts = np.concatenate(([0], cuts))
    # two places need no tree
    i = firsts[sizes == 2]
    a, b, depth = np.minimum(place[i], place[i + 1]), np.maximum(place[i], place[i + 1]), shared[i]
    ok = (b - a <= depth // (rule.times - 1)) & (left[a] != left[b])
    found = [np.stack([a[ok], b[ok], depth[ok]], axis=1)]
    more = []
    lefts = left.tolist() if (sizes > 2).any() else []
    for i, n in zip(firsts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        more += _tree_pairs(place[i : i + n].tolist(), shared[i : i + n - 1].tolist(), rule, lefts)
    found.append(np.array(more, np.int64).reshape(-1, 3))
    pairs = np.concatenate(found)
    return np.concatenate([pairs[:, :2] - np.searchsorted(ends, pairs[:, :1]), pairs[:, 2:]], axis=1)


def runs_of(words: np.ndarray, bounds: np.ndarray, rule: Rule) -> np.ndarray:
    """Rows (start, length, period) of the runs, by start and period; starts count all documents' words."""
    pairs = maximal_pairs(words, bounds, rule)
    start, period = pairs[:, 0], pairs[:, 1] - pairs[:, 0]
    length = pairs[:, 2] + period
    enough = length >= rule.least
    start, period, length = start[enough], period[enough], length[enough]
    # a stretch pairs with itself at every multiple of its period: the smallest one counts
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    runs = np.stack([start[first], length[first], period[first]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slices(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of consecutive texts of about SLICE_BYTES together."""
    part: list[list[bytes]] = []
    size = 0
    for t in texts:
        raw = (t or "").encode()
        if part and size + len(raw) > SLICE_BYTES:
            yield part
            part, size = [], 0
        part.append(raw.split())  # bytes: the six ASCII blanks only
        size += len(raw)
    if part:
        yield part


def _slice_runs(part: list[list[bytes]], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The runs of the documents of a slice, and where each document's begin and end in them."""
    bounds = np.cumsum([0, *map(len, part)])
    words = np.empty(int(bounds[-1]), object)
    words[:] = [w for doc in part for w in doc]
    runs = runs_of(pd.factorize(words)[0].astype(np.int64), bounds, rule)
    owned = np.searchsorted(runs[:, 0], bounds)
    owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    runs[:, 0] -= bounds[owner]
    return runs, owned


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run has after its first period."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = list(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))
    return b" ".join(words).decode()


def find_runs(
    df: DataFrame, text: str = "text", least: int = 6, times: int = 4, name: str = "runs", collapsed: str | None = None
) -> DataFrame:
    """Add the runs of each text as an array of (``start``, ``length``, ``period``), by start and period.

    All three count words, which are runs without ASCII blanks, unchanged. A run has at least ``least`` words and
    ``times`` of its smallest periods; neither neighbour continues it. With ``collapsed`` a column of that name holds
    the words that no run has after its first period, joined by single blanks.

    Rows are independent, so copies and repeated rows have the same runs and an empty table has none. Null, empty
    and blank texts have no words and no runs (an empty array, never null). A text is one row and is handled
    whole in its task, with memory in proportion to it. All columns stay; those with a name of the new ones are replaced.
    """
    df = make_room(df, *filter(None, (name, collapsed)))
    rule = Rule(least, times)
    more = [(collapsed, T.StringType())] if collapsed else []
    schema, arrow = extended(df, (name, T._parse_datatype_string(RUN)), *more)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sizes, kept = [], [], []
            for part in _slices(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                runs, owned = _slice_runs(part, rule)
                parts.append(runs)
                sizes.append(np.diff(owned))
                if collapsed:
                    kept += [_collapsed(w, runs[i:j]) for w, i, j in zip(part, owned, owned[1:])]
            runs = np.concatenate(parts) if parts else np.empty((0, 3), np.int64)
            offsets = np.concatenate(([0], *map(np.cumsum, [np.concatenate(sizes)] if sizes else [])))
            struct = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)
            yield append(batch, arrow, column, *([pa.array(kept, pa.string())] if collapsed else []))

    return map_arrow(df, work, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods; ties go to the smallest start, then period. Null for no runs."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(
        runs,
        none,
        # in integers, so that equal quotients are equal
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )


def as_lines(runs: Column) -> Column:
    """``start,length,period`` of every run, each with a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_runs(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Make the end of one text in ten periodic, as a function of the id alone.

    With h the CRC-32 of the decimal id and g = h div 10, the texts with h mod 10 = 0 have every word i from a = g mod n on
    replaced by word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8); words are joined by single blanks. All other
    texts, those without words and those of a null id stay as they are.
    """
    h = F.crc32(F.col(row_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")

    # in an array of one, so that the words are cut once and not for every word
    words = F.array(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    edited = F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return df.withColumn(text, F.coalesce(F.when(F.pmod(h, F.lit(10)) == 0, edited), F.col(text)))

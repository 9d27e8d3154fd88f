"""Substring deduplication by a relative Lempel-Ziv parse against all earlier documents.

The reference is every document with a smaller id. Its index maps a seed, the hash of ``window``
consecutive words, to the smallest id it starts in; the hash partitions of that index are the reference
blocks. A document is factored greedily from the left: a factor begins at a word whose seed an earlier
document has and grows while the next seed is indexed too. At the end of a factor the parse steps back
``window - 1`` words, so a match across the boundary is found as well. Factors reach ``window`` words by
construction and become duplicate spans.

Only a small part of all seeds is ever shuffled. Every window names one anchor, the smallest hash of
its shorter runs of words; equal windows name equal anchors. Anchors come first, about one in five
words; seeds follow only for windows whose anchor another document has as well. What goes back to a
document is what is its own, one row per anchor or seed, and never one row per copy: a passage in a
third of all documents is a single sum on each side of a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, make_room, map_arrow

WINDOW = 13
RUN = 5  # words of the runs an anchor is chosen from
SLICE_BYTES = 1 << 20  # text hashed at once
_LOWEST = -(1 << 63)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer (fixed constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    return _mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = int(_odd(1, 7)[0])


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2^64: all odd, so no byte of a word is lost."""
    factors = np.full(max(n, 1), _BASE, _U)
    factors[0] = 1
    return np.cumprod(factors, dtype=_U)


class Words:
    """Word hashes of several texts in a row. ``bounds[i]:bounds[i + 1]`` are the words of text i."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        blank = _BLANK[raw] if len(raw) else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
        starts, ends = edge[::2], edge[1::2]
        if len(starts):
            lengths = ends - starts
            stretches = np.diff(np.concatenate(([0], starts, [len(raw)])))
            place = np.arange(len(raw)) - np.repeat(np.concatenate(([0], starts)), stretches)
            place = np.where(blank, 0, place)  # of a byte in its word
            value = np.where(blank, _U(0), (raw.astype(_U) + _U(1)) * _powers(int(lengths.max()))[place])
            self.hash = _mix(np.add.reduceat(value, starts) + lengths.astype(_U) * _U(0xD6E8FEB86659FD93))
        else:
            self.hash = np.zeros(0, _U)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.bounds = np.searchsorted(starts, offsets)

    def runs(self, words: int, seed: int) -> np.ndarray:
        """Hash of the run of ``words`` words at each place where one fits into all texts in a row."""
        n = len(self.hash) - words + 1
        if n <= 0:
            return np.zeros(0, _U)
        total = np.zeros(n, _U)
        for j, c in enumerate(_odd(words, seed)):
            total += self.hash[j : j + n] * c
        return _mix(total)

    def anchors(self, window: int, run: int) -> np.ndarray:
        """The anchor of the window at each place."""
        h = self.runs(run, 11)
        n = len(self.hash) - window + 1
        if n <= 0:
            return np.zeros(0, _U)
        out = h[:n].copy()
        for j in range(1, window - run + 1):
            np.minimum(out, h[j : j + n], out=out)
        return out

    def windows(self, text: int, window: int) -> slice:
        """The places where a window of text ``text`` starts."""
        a, b = int(self.bounds[text]), int(self.bounds[text + 1])
        return slice(a, max(a, b - window + 1))


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about SLICE_BYTES together, with the place of the first."""
    part: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts):
        t = (t or "").encode()
        if part and size + len(t) > SLICE_BYTES:
            yield first, part
            part, first, size = [], i, 0
        part.append(t)
        size += len(t)
    if part:
        yield first, part


def _list(column: pa.Array, i: int) -> np.ndarray:
    """The numbers in row ``i`` of a list column, as unsigned; none for null."""
    item = column[i]
    return item.values.to_numpy(zero_copy_only=False).view(_U) if item.is_valid else np.zeros(0, _U)


def _anchor_rows(docs: DataFrame, window: int, run: int) -> DataFrame:
    arrow = pa.schema([("anchor", pa.int64()), ("id", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, part in _slices(batch.column(1).to_pylist()):
                w = Words(part)
                a = w.anchors(window, run)
                keep = np.zeros(len(a), bool)
                owner = np.zeros(len(a), np.int64)
                for i in range(len(part)):
                    s = w.windows(i, window)
                    if s.stop > s.start:
                        keep[s] = True
                        keep[s.start + 1 : s.stop] = a[s.start + 1 : s.stop] != a[s.start : s.stop - 1]
                        owner[s] = ids[first + i]
                yield pa.RecordBatch.from_arrays([pa.array(a[keep].view(np.int64)), pa.array(owner[keep])], schema=arrow)

    return map_arrow(docs.select("id", "text"), work, "anchor long, id long")


def _seed_rows(docs: DataFrame, window: int, run: int) -> DataFrame:
    """Seeds of the windows whose anchor is not the document's alone (``own`` lists those)."""
    arrow = pa.schema([("seed", pa.int64()), ("more", pa.int32()), ("id", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for first, part in _slices(batch.column(1).to_pylist()):
                w = Words(part)
                a, seed, more = w.anchors(window, run), w.runs(window, 13), w.runs(window, 17)
                keep = np.zeros(len(a), bool)
                owner = np.zeros(len(a), np.int64)
                for i in range(len(part)):
                    s = w.windows(i, window)
                    if s.stop > s.start:
                        keep[s] = ~np.isin(a[s], _list(own, first + i))
                        owner[s] = ids[first + i]
                columns = [seed[keep].view(np.int64), (more[keep] >> _U(32)).astype(np.uint32).view(np.int32), owner[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    return map_arrow(docs, work, "seed long, more int, id long")


def factors(found: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Greedy parse of a document, given at which words an indexed seed starts: (start, stop) of factors."""
    at = np.flatnonzero(found)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > 1)
    starts, lasts = at[np.concatenate(([0], breaks + 1))], at[np.append(breaks, len(at) - 1)]
    return list(zip(starts.tolist(), (lasts + window).tolist(), strict=True))


def find_repeats(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", window: int = WINDOW, run: int = RUN
) -> DataFrame:
    """Add ``n_words`` (long) and ``factors``, the spans of words that smaller ids have as well.

    ``factors`` is an array of (``start``, ``stop``) in words, in order; neighbours may overlap by less than a
    window. Words are runs without ASCII blanks, unchanged; null texts have none. Ids are integers;
    a null id counts as smaller than any other, and rows of one id, repeated ones included, never repeat each
    other. All columns stay; those called ``n_words`` or ``factors`` are replaced.
    """
    names = ("n_words", "factors")
    df = make_room(df, *names)
    if not 0 < run <= window:
        raise ValueError("an anchor is chosen from runs of at most the window's words")
    key = F.coalesce(F.col(row_id).cast("long"), F.lit(_LOWEST))
    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    rows = df.select(key.alias("id"), F.col(text).alias("text"), F.struct(*rest, F.lit(0).alias("__")).alias("rest"))

    # the texts are dealt by id once, and both joins below read that
    dealt = rows.repartition("id")
    alone = _anchor_rows(rows, window, run).groupBy("anchor").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    own = alone.filter("id = last").groupBy("id").agg(F.collect_list("anchor").alias("own"))
    with_own = dealt.join(own.hint("shuffle_hash"), "id", "left").select("id", "text", "own", "rest")

    seeds = _seed_rows(with_own, window, run).groupBy("seed", "more").agg(F.min("id").alias("id"))
    first = seeds.groupBy("id").agg(F.collect_list("seed").alias("first"))
    both = with_own.join(first.hint("shuffle_hash"), "id", "left")

    fields = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    schema, arrow = extended(both.select("rest", "text"), ("n_words", T.LongType()), ("factors", fields))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, first = batch.column(2), batch.column(3)
            n_words, spans = [], []
            for at, part in _slices(batch.column(1).to_pylist()):
                w = Words(part)
                a, seed = w.anchors(window, run), w.runs(window, 13)
                for i in range(len(part)):
                    s = w.windows(i, window)
                    n_words.append(int(w.bounds[i + 1] - w.bounds[i]))
                    found = ~(np.isin(a[s], _list(own, at + i)) | np.isin(seed[s], _list(first, at + i)))
                    spans.append([{"start": x, "stop": y} for x, y in factors(found, window)])
            yield append(
                batch.select([0, 1]), arrow, pa.array(n_words, pa.int64()), pa.array(spans, arrow.field("factors").type)
            )

    out = map_arrow(both.select("rest", "text", "own", "first"), work, schema)
    columns = [F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in df.columns]
    return out.select(*columns, *names)


def keep_words(df: DataFrame, text: str = "text", name: str = "kept") -> DataFrame:
    """Add the text without the words in ``factors``, joined by single blanks, and ``n_removed`` (long).

    Columns that have one of these names are replaced.
    """
    df = make_room(df, name, "n_removed")
    schema, arrow = extended(df, (name, T.StringType()), ("n_removed", T.LongType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()  # noqa: E731, B023
            kept, gone = [], []
            for t, spans in zip(column(text), column("factors"), strict=True):
                w, out, at = (t or "").encode().split(), [], 0
                for s in spans or []:
                    out += w[at : s["start"]]
                    at = max(at, s["stop"])
                out += w[at:]
                kept.append(b" ".join(out).decode())
                gone.append(len(w) - len(out))
            yield append(batch, arrow, pa.array(kept, pa.string()), pa.array(gone, pa.int64()))

    return map_arrow(df, work, schema)

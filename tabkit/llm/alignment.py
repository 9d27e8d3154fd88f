"""Where the tokens of two tokenizers end together, and how often which of them do.

Equal texts are tokenised and aligned once: texts are shuffled whole and grouped, pair counts are weighted by
the number of copies, and what is measured on a text goes back to its rows by the text's digest. A text
that a third of all rows have is one group, combined before the shuffle.

Of two tokens that end together the bytes of one end with those of the other. So a vocabulary has at most
as many pairs as both have bytes, times the few ids with equal bytes: some hundred thousand, whatever the corpus. The counts
of pairs are therefore sent to the tasks whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.bpe import SPLIT, byte_symbols
from tabkit.llm.common import make_room, map_arrow
from tabkit.llm.tokens import ROW, column, groups, parts, read_text, tokenizer
from tabkit.operators.joins import lookup_join
from tabkit.runtime import materialize

# Links counted together in a task before they are sent on.
COUNT_LINKS = 1 << 20
# Pieces a worker remembers, and their characters; forgetting changes no result.
KNOWN_PIECES, KNOWN_CHARS = 200_000, 4 << 20
_WORD = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Aligner:
    """A byte-level tokenizer (A) and a piece model with a blank in front (B), side by side."""

    def __init__(self, spec: str, model: bytes):
        self.a = tokenizer(spec, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {s: b for b, s in byte_symbols().items()}
        special = self.a.get_added_tokens_decoder()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [e.encode() if i in special else bytes(byte_of[c] for c in e) for i, e in enumerate(entries)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.lengths_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # without a normal form, and with no split but the usual one, a text's ids are those of its pieces
        layout = json.loads(spec)
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_pieces = layout["normalizer"] is None and usual.items() <= (layout["pre_tokenizer"] or {}).items()
        self.by_pieces &= layout["model"]["type"] == "BPE" and not layout["model"].get("dropout")
        self.known: dict[str, bytes] = {}
        self.chars = 0
        # every id followed by each of the signs that may come after it
        n = self.names = max(len(self.bytes_a), len(self.bytes_b))
        self.shown = [str(i) + sign for sign in ",|;" for i in range(n)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of A, each different piece of the split encoded once while it is remembered: pieces do not merge."""
        if not self.by_pieces:
            return [np.array(e.ids, np.int64) for g in groups(texts) for e in self.a.encode_batch_fast(g, add_special_tokens=False)]
        out = []
        for group in groups(texts):
            cut = [SPLIT.findall(t) for t in group]
            if len(self.known) > KNOWN_PIECES or self.chars > KNOWN_CHARS:
                self.known, self.chars = {}, 0
            self._learn([p for p in set().union(*cut) if p not in self.known])
            look = self.known.__getitem__
            out += [np.frombuffer(b"".join(map(look, pieces)), "<u4").astype(np.int64) for pieces in cut]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, those of a blank and letters many in a row, which the split takes apart again."""
        rows = list(filter(_WORD, pieces))
        for i in range(0, len(rows), ROW):
            row = rows[i : i + ROW]
            ids = np.array(self.a.encode_batch_fast(["".join(row)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.lengths_a[ids]), np.cumsum([len(p.encode()) for p in row])) + 1
            raw, start = ids.tobytes(), 0
            for piece, end in zip(row, (4 * ends).tolist(), strict=True):
                self.known[piece] = raw[start:end]
                start = end
        alone = [p for p in pieces if p not in self.known]
        found = (e.ids for g in groups(alone) for e in self.a.encode_batch_fast(g, add_special_tokens=False))
        self.known.update((p, np.array(ids, "<u4").tobytes()) for p, ids in zip(alone, found, strict=True))
        self.chars += sum(map(len, pieces))

    def tokenize(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A for a blank and the text, and of B for the text. Long texts are encoded in parts."""
        cut = [parts(t) for t in texts]
        every = [p for ps in cut for p in ps]
        found_a = (ids for g in groups(every) for ids in self.encode_a([" " + p for p in g]))
        found_b = (np.array(ids, np.int64) for g in groups(every) for ids in self.b.encode(g, num_threads=1))
        for ps in cut:
            yield tuple(np.concatenate([next(f) for _ in ps]) for f in (found_a, found_b))

    def align(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, str] | None:
        """Number of groups, links as A id * size of B + B id, and the groups in writing; None where bytes differ."""
        raw = b" " + text.encode()
        if not text or self.lengths_b[b].sum() != len(raw) or self.lengths_a[a].sum() != len(raw):
            return None
        if b"".join(map(self.bytes_b.__getitem__, b.tolist())) != raw or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw:
            return None
        end_a, end_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        links = a[last_a] * len(self.bytes_b) + b[last_b]
        # A's tokens of a group, then B's: each token moves on by those of the other side before it
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        before = np.concatenate(([0], last_b + 1))
        shown = np.empty(len(a) + len(b), np.int64)
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[last_a], sign_b[last_b] = self.names, 2 * self.names
        shown[np.arange(len(a)) + before[group_a]] = a + sign_a
        shown[np.arange(len(b)) + last_a[group_b] + 1] = b + sign_b
        return len(ends), links, "".join(map(self.shown.__getitem__, shown.tolist()))[:-1]


@lru_cache(maxsize=2)
def aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(spec, model)


def _aligned(texts: DataFrame, spec, model) -> DataFrame:
    """Distinct (text, copies) aligned: (key, copies, n_a, n_b, n_groups, n_links, groups_sha256, links)."""
    fields = [("key", pa.binary()), *((n, pa.int64()) for n in ("copies", *MEASURES[:4])), ("groups_sha256", pa.string()), ("links", pa.binary())]
    arrow = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(spec.value, model.value)
        for batch in batches:
            found, rows = column(batch, "text").to_pylist(), []
            for text, (a, b) in zip(found, both.tokenize(found), strict=True):
                n, links, shown = both.align(text, a, b) or (0, np.zeros(0, np.int64), None)
                sizes = (len(a), len(b), n, len(links)) if shown is not None else (0,) * 4
                rows.append((*sizes, "" if shown is None else hashlib.sha256(shown.encode()).hexdigest(), links.astype("<i8").tobytes()))
            cells = list(zip(*rows, strict=True)) or [()] * 6
            given = [column(batch, "key"), column(batch, "copies")]
            yield pa.RecordBatch.from_arrays([*given, *(pa.array(c, f.type) for c, f in zip(cells, list(arrow)[2:]))], schema=arrow)

    schema = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
    return map_arrow(texts, run, schema)


def _flat(links: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a batch in a row, and how many each text has."""
    raw = links.to_pylist()
    return np.frombuffer(b"".join(raw), "<i8"), np.fromiter((len(x) // 8 for x in raw), np.int64, len(raw))


def _pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of all texts, copies included, hold each pair."""
    arrow = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
        total = np.add.reduceat(n, first) if len(first) else n
        return pa.RecordBatch.from_arrays([pa.array(pairs[first]), pa.array(total)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            links, sizes = _flat(column(batch, "links"))
            kept.append((links, np.repeat(column(batch, "copies").to_numpy(), sizes)))
            size += len(links)
            if size >= COUNT_LINKS:
                yield summed(kept)
                kept, size = [], 0
        if kept:
            yield summed(kept)

    counted = map_arrow(aligned.select("copies", "links"), run, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def _measured(aligned: DataFrame, pairs: np.ndarray, n: np.ndarray, size_b: int) -> DataFrame:
    """The aligned texts with ``n_best`` and ``count_sum`` in place of their links. ``pairs`` are sorted."""
    b = pairs % size_b
    most = np.zeros(size_b, np.int64)
    np.maximum.at(most, b, n)
    shared = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == most[b]))
    names = ["key", *MEASURES[:4], "groups_sha256", "n_best", "count_sum"]
    types = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int64()]
    arrow = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for batch in batches:
            links, sizes = _flat(column(batch, "links"))
            at = np.searchsorted(known, links)
            total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x[at], dtype=np.int64)))[np.concatenate(([0], np.cumsum(sizes)))])  # noqa: E731, B023
            kept = [column(batch, name) for name in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(total(best)), pa.array(total(count))], schema=arrow)

    return map_arrow(aligned.drop("copies"), run, "key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def align(df: DataFrame, byte_level: str, pieces: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` without the text and with the measures of its alignment, and the counts of all pairs.

    ``byte_level`` is a byte-level tokenizer file (A) and ``pieces`` a piece model that puts a blank in front of a text (B);
    the driver reads both and their content goes to the tasks. A encodes a blank and the text, B the text,
    without special tokens, whose names in a text are plain text. Bytes where a token of both ends cut the tokens into groups; a
    link is a pair of tokens that end together. The measures: ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best``
    (links whose pair is linked as often in all of the rows as any other of its B id), ``count_sum`` (over the links, how
    often their pair is) and ``groups_sha256`` of ``a1,a2|b1;a3|b2,b3``. The counts are (``a``, ``b``, ``n``).

    Texts that are null, empty or not what the tokens' bytes join to have no tokens: zeros, and an empty
    ``groups_sha256``. Repeated rows and copies each count and each have a row; ids are not looked at. Ties are all best.
    Long texts are encoded in parts. An empty table gives two empty ones. Columns of ``df`` with a name of the new ones are replaced.
    """
    sc = df.sparkSession.sparkContext
    spec = sc.broadcast(read_text(byte_level))
    with open(pieces, "rb") as f:
        model = sc.broadcast(f.read())
    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()

    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    texts = df.select(F.col(text).alias("text")).filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = materialize(_aligned(texts.withColumn("key", digest), spec, model), "aligned-texts")
    counts = materialize(_pair_counts(aligned), "aligned-pairs")
    found = counts.orderBy("pair").toArrow()  # bounded by the vocabularies, see above
    measured = materialize(_measured(aligned, *(found.column(c).to_numpy() for c in ("pair", "n")), size_b), "aligned-measures")

    new = [*MEASURES, "groups_sha256"]
    keep = [c for c in make_room(df, *new).columns if c != text]
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("__")).alias("row"),
        F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256)).alias("key"),
    )
    # never broadcast, as the texts grow with the rows; a text that very many rows have is salted
    joined = lookup_join(rows, measured, "key", small=False)
    columns = [*(F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    pair = F.col("pair")
    return joined.select(*(F.col("row")[c].alias(c) for c in keep), *columns), counts.select(
        F.floor(pair / size_b).alias("a"), F.pmod(pair, F.lit(size_b)).alias("b"), "n"
    )

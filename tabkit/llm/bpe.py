"""Byte-level BPE encoding and decoding with a pair occurrence index.

A batch of texts is cut into pieces at white space, and only its distinct pieces are encoded. All
of them lie in one array of symbols; an index maps every mergeable pair to all its positions. The
active ranks are taken in ascending order; each merges all occurrences of its pair at once and
updates the lists of the pairs beside them. A merge only ever creates pairs of higher rank, so the
result is what merging piece by piece gives.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, make_room, map_arrow

# Unicode White_Space, which the tokenizer's \s means.
_SPACE = r"\t-\r \x85\xa0  -     　"
# A piece never shares a token with its neighbours: a run without white space takes one blank before it.
_PIECE = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# The tokenizer's split within a piece (fixed by the file format).
SPLIT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Distinct pieces remembered per task; the memory is emptied when full, which changes no result.
CACHE_PIECES = 150_000
# Bytes of text encoded together: one index is made for them.
GROUP_BYTES = 4 << 20


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE tokenizer read from a tokenizer file's JSON text.

    Only what such files use is supported: no normalizer, byte-level splitting without an added
    blank, plain merges. Anything else raises.
    """

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["type"] != "BPE":
            raise ValueError("not a plain byte-level BPE file")
        symbol = byte_symbols()
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.byte_id = np.array([vocab[symbol[b]] for b in range(256)], np.int32)
        left, right, made = (np.array([vocab[p] for p in part], np.int64) for part in zip(*((a, b, a + b) for a, b in pairs)))
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.left, self.right, self.made = left, right, made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with strip rules")
        longest = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        byte_of = {s: b for b, s in symbol.items()}
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.cache: dict[str, bytes] = {}

    # -- encoding ---------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        same: dict[str, str] = {}  # one string for all occurrences of a piece
        cut = [[same.setdefault(p, p) for p in self._pieces(t)] for t in texts]
        if len(self.cache) > CACHE_PIECES:
            self.cache = {}
        self._learn([p for p in same if p not in self.cache])
        look = self.cache.__getitem__
        return [b"".join(map(look, pieces)) for pieces in cut]

    def _pieces(self, text: str) -> list[str]:
        if not self.special_split:
            return _PIECE.findall(text)
        parts = self.special_split.split(text)
        if len(parts) == 1:
            return _PIECE.findall(text)
        out: list[str] = []
        for i, part in enumerate(parts):
            out += [part] if i % 2 else _PIECE.findall(part)
        return out

    def _learn(self, pieces: list[str]) -> None:
        plain = []
        for p in pieces:
            if p in self.special:
                self.cache[p] = np.array([self.special[p]], "<u4").tobytes()
            else:
                plain.append(p)
        if not plain:
            return
        words = list(map(SPLIT.findall, plain))
        raw = np.frombuffer("".join(plain).encode(), np.uint8)
        first = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # where each character starts
        piece_ends = first[np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))]
        lengths = np.fromiter(map(len, itertools.chain.from_iterable(words)), np.int64)
        ids, at = self._merge(raw, first[np.cumsum(lengths)])
        # symbols left in each piece: a piece starts where its first byte was
        packed, begin = ids.astype("<u4").tobytes(), 0
        for p, end in zip(plain, (4 * np.searchsorted(at, piece_ends)).tolist(), strict=True):
            self.cache[p] = packed[begin:end]
            begin = end

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is no merge."""
        key = (a.astype(np.int64) << 32) | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.ranks[i], -1)

    def _merge(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words whose bytes end at ``ends``, and the byte each id starts at."""
        sym = self.byte_id[raw]
        n = len(sym)
        nxt = np.arange(1, n + 1, dtype=np.int32)
        prv = np.arange(-1, n - 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv[np.concatenate(([0], ends[:-1]))] = -1
        live = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            rank = self._rank(sym[positions], sym[nxt[positions]])
            found = rank >= 0
            rank, positions = rank[found], positions[found]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, positions = rank[order], positions[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, p in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts), strict=True):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        add(np.flatnonzero(nxt >= 0).astype(np.int32))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            p = lists[0] if len(lists) == 1 else _sorted(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            q = nxt[p]
            ok = live[p] & (sym[p] == a) & (q >= 0)
            ok &= sym[q] == b
            p, q = p[ok], q[ok]
            if a == b and len(p):
                p, q = _apart(p, q)
            if not len(p):
                continue
            sym[p] = self.made[r]
            live[q] = False
            after = nxt[q]
            nxt[p] = after
            prv[after[after >= 0]] = p[after >= 0]
            before = prv[p]
            add(_sorted(np.concatenate((before[before >= 0], p[after >= 0]))))
        at = np.flatnonzero(live)
        return sym[at], at

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        i = np.frombuffer(ids, "<u4")
        if not len(i):
            return ""
        size = self.lengths[i]
        total = np.cumsum(size)
        where = np.repeat(self.starts[i] - (total - size), size) + np.arange(total[-1])
        return self.bytes[where].tobytes().decode("utf-8", "replace")


def _sorted(p: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order."""
    p = np.sort(p)
    return p[np.append(True, p[1:] != p[:-1])] if len(p) else p


def _apart(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost occurrences of a pair of equal symbols that do not overlap."""
    keep, used = np.zeros(len(p), bool), -1
    for i, (x, y) in enumerate(zip(p.tolist(), q.tolist(), strict=True)):
        if x != used:
            keep[i], used = True, y
    return p[keep], q[keep]


def _groups(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive batches with about GROUP_BYTES of text together."""
    group: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        group.append(batch)
        size += batch.column(batch.schema.get_field_index(text)).nbytes
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(
    df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add the packed token ids of ``text`` as a binary column (little-endian unsigned 32-bit).

    With ``decoded`` the text that the ids decode to is added too, in the same pass: see `decode`.

    ``tokenizer`` is the path of a tokenizer file that the driver can read; its content goes to the tasks, and
    its size (a few megabytes) does not depend on the data. A null text is encoded like an empty
    one, as no ids. Rows are independent: copies, ties and an empty table need no special case, and
    the other columns pass through; those with a name of the new
    ones are replaced.
    """
    df = make_room(df, *filter(None, (ids, decoded)))
    with open(tokenizer, encoding="utf-8") as f:
        bpe = df.sparkSession.sparkContext.broadcast(ByteBpe(f.read()))
    more = [(decoded, T.StringType())] if decoded else []
    schema, arrow = extended(df, (ids, T.BinaryType()), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, text):
            texts = [[t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()] for b in group]
            out = iter(bpe.value.encode(list(itertools.chain.from_iterable(texts))))
            for batch in group:
                found = list(itertools.islice(out, batch.num_rows))
                columns = [pa.array(found, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(bpe.value.decode, found), pa.string()))
                yield append(batch, arrow, *columns)

    return map_arrow(df, run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of packed ids. Null ids give an empty text; special tokens keep their text.

    A column called ``text`` already is replaced.
    """
    df = make_room(df, text)
    with open(tokenizer, encoding="utf-8") as f:
        bpe = df.sparkSession.sparkContext.broadcast(ByteBpe(f.read()))
    schema, arrow = extended(df, (text, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            yield append(batch, arrow, pa.array([bpe.value.decode(x or b"") for x in column.to_pylist()], pa.string()))

    return map_arrow(df, run, schema)

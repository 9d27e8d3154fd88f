"""Tokenizer files for the tasks, and long texts in parts that are encoded one by one."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from tabkit.llm.bpe import byte_symbols

# Bytes of text encoded together, and characters of one part of a long text: they bound a worker's memory.
GROUP_BYTES = 1 << 20
PART_CHARS = 1 << 18
# Bytes of text whose words are told apart together, and different words that are cut into pieces together.
WORDS_BYTES, WORDS_CUT = 8 << 20, 1 << 18
# Pieces of words beyond which, or beyond whose bytes, a worker forgets those not met just now; it changes no result.
KNOWN_WORDS, KNOWN_BYTES = 300_000, 24 << 20
# New pieces encoded in one call, and what plain words are made of: signs and letters that no normal form changes.
ROW = 1000
_PLAIN, _LETTERS = "[!-~À-ÖØ-öø-ÿ]+", "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_SYMBOLS = {c: "".join(byte_symbols()[b] for b in c.encode()) for c in map(chr, range(0xDF, 0x100))}  # lower case only
# One blank between ASCII letters: no tokenizer used here has a token that reaches over it from both sides.
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


@lru_cache(maxsize=4)
def tokenizer(spec: str, special_as_text: bool = False) -> Tokenizer:
    """The tokenizer of a file's JSON text, kept by the worker; without truncation and padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    out = Tokenizer.from_str(spec)
    out.no_truncation()
    out.no_padding()
    out.encode_special_tokens = special_as_text
    return out


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def parts(text: str, chars: int = PART_CHARS) -> list[str]:
    """The text cut at single blanks between ASCII letters into parts of about ``chars``; those blanks are left out."""
    out, at = [], 0
    while len(text) - at > chars:
        cut = _CUT.search(text, at + chars)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def groups(texts: Iterable[str], size: int = GROUP_BYTES) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together."""
    group: list[str] = []
    total = 0
    for t in texts:
        group.append(t)
        total += len(t)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def batch_groups(batches: Iterable[pa.RecordBatch], name: str, size: int = WORDS_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive batches with at most ``size`` bytes of the column together, or one alone."""
    group: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        n = column(batch, name).nbytes
        if group and total + n > size:
            yield group
            group, total = [], 0
        group.append(batch)
        total += n
    if group:
        yield group


class WordEncoder:
    """Packed ids of texts, little-endian unsigned 32-bit.

    Where a tokenizer drops white space and no token reaches over it, the stretches between blanks and line ends are encoded
    one by one, each different one of a call once, and the pieces of plain ones once while they are remembered. Texts of other
    tokenizers are encoded as they are.
    """

    def __init__(self, spec: str):
        self.of = tokenizer(spec)
        self.pieces = self.ends = self.bare = None
        blank, one, other, *both = self._ids([" ", "a", "b", "a b", "a\nb"])
        self.by_words = blank == b"" and both == [one + other] * 2
        self._read_pieces(json.loads(spec))
        # pieces of plain words met before and their ids; the blank between words is the first
        self.names, self.known = pa.array([" "], pa.string()), pa.array([b""], pa.binary())

    def _read_pieces(self, spec: dict) -> None:
        """What plain words need of the file: its pattern, its merges alone, and which tokens end a piece."""
        suffix, split = spec["model"].get("end_of_word_suffix"), (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        lower = {"type": "Lowercase"} in (spec["normalizer"] or {}).get("normalizers", [])
        if self.by_words and lower and suffix and split.get("type") == "Split" and "Regex" in split["pattern"]:
            self.pieces = regex.compile(f"(?:{split['pattern']['Regex']})| ")  # and the blanks between words
            vocab = self.of.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(self.of.get_vocab_size(), bool)
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            blank = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
            merges = {"normalizer": None, "pre_tokenizer": blank, "added_tokens": []}
            self.bare = tokenizer(json.dumps({**spec, **merges}))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = (e.ids for g in groups(texts) for e in self.of.encode_batch_fast(g, add_special_tokens=False))
        return [np.array(ids, "<u4").tobytes() for ids in found]

    def _learn(self, pieces: list[str]) -> list[pa.Array]:
        """Ids of new pieces by the merges alone, many in a row, which saves most of the time."""
        out = []
        for i in range(0, len(pieces), ROW):
            row = pieces[i : i + ROW]
            text = " ".join(row)
            for c in set(text) & _SYMBOLS.keys():
                text = text.replace(c, _SYMBOLS[c])
            ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(row):
                out.append(_entries(pa.py_buffer(ids), 4 * np.append(0, stop)))
            else:  # a piece without a token that ends one
                found = self.bare.encode_batch_fast(text.split(" "), add_special_tokens=False)
                out.append(pa.array([np.array(e.ids, "<u4").tobytes() for e in found], pa.binary()))
        return out

    def _plain(self, letters: pa.Array, signs: pa.Array) -> pa.Array | None:
        """Ids of plain words, those of letters alone and the others; None if a piece of these reaches over a blank."""
        one = pa.ListArray.from_arrays(pa.array([0, len(signs)], pa.int32()), pc.utf8_lower(signs))
        cut = self.pieces.findall(pc.binary_join(one, " ")[0].as_py()) if len(signs) else []
        # what is remembered comes first, so that a piece's number in the dictionary is its place there
        n = len(self.names)
        pieces = pa.concat_arrays([self.names, pc.utf8_lower(letters), pa.array(cut, pa.string())]).dictionary_encode()
        new, order = pieces.dictionary[n:], pieces.indices.to_numpy()[n:]
        if pc.any(pc.match_substring(new, " ")).as_py():
            return None
        self.names, self.known = pieces.dictionary, pa.concat_arrays([self.known, *self._learn(_strings(new))])
        stops = np.append(len(letters) + np.flatnonzero(order[len(letters) :] == 0), [len(order)] * (len(signs) > 0))
        found = _joined(self.known, order, np.append(np.arange(1, len(letters) + 1), stops).astype(np.int64))
        if len(self.names) > KNOWN_WORDS or self.names.nbytes > KNOWN_BYTES:
            used = np.zeros(len(self.names), bool)
            used[order] = used[0] = True
            self.names, self.known = self.names.filter(pa.array(used)), self.known.filter(pa.array(used))
        return found

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of different words: plain ones by their pieces and others as texts."""
        if not self.pieces:
            return pa.array(self._ids(_strings(words)), pa.binary())
        plain = pc.and_not(pc.match_substring_regex(words, f"^{_PLAIN}$"), pc.match_substring(words, "<|"))
        letters = pc.match_substring_regex(words, f"^{_LETTERS}$")
        kinds = [letters, pc.and_not(plain, letters), pc.invert(plain)]
        of_letters, signs, others = (words.filter(k) for k in kinds)
        found = self._plain(of_letters, signs)
        if found is None:
            return pa.array(self._ids(_strings(words)), pa.binary())
        found = pa.concat_arrays([found, pa.array(self._ids(_strings(others)), pa.binary())])
        at = np.concatenate([np.flatnonzero(k.to_numpy(zero_copy_only=False)) for k in kinds])
        return found.take(pa.array(np.argsort(at)))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Packed ids of each text, a null one empty, and ``end`` behind them."""
        texts = texts.fill_null("")
        if not self.by_words:
            return pa.array([ids + end for ids in self._ids(texts.to_pylist())], pa.binary())
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = cut.flatten().dictionary_encode()
        found = [self._words(words.dictionary[i : i + WORDS_CUT]) for i in range(0, len(words.dictionary), WORDS_CUT)]
        ids = pa.concat_arrays([*found, pa.array([end], pa.binary())])
        # ``end`` is one more word behind each text's
        stops = pc.list_value_length(cut).to_numpy().cumsum()
        order = np.insert(words.indices.to_numpy(), stops, len(words.dictionary))
        return _joined(ids, order, stops + np.arange(1, len(stops) + 1))


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _joined(ids: pa.Array, order: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The ids at ``order`` one after the other, as one entry up to each of ``stops``."""
    if not len(order):
        return pa.array([b""] * len(stops), pa.binary())
    _, at, raw = ids.take(pa.array(order)).buffers()
    return _entries(raw, np.frombuffer(at, np.int32)[np.append(0, stops)])


def _entries(raw: pa.Buffer, at: np.ndarray) -> pa.Array:
    """The bytes from each of ``at`` to the next."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), raw])


@lru_cache(maxsize=4)
def word_encoder(spec: str) -> WordEncoder:
    return WordEncoder(spec)

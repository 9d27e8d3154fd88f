"""Alignment of two tokenizers against their libraries and plain counting, text by text."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabkit.llm import alignment
from tabkit.llm.bpe import byte_symbols
from tabkit.llm.queries import QUERIES, tokenizer_file
from tabkit.llm.tokens import parts

FOLDER = "/root/testdata/sf0.001"
FILES = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def tokens_of(text, libraries):
    """(id, end) of the tokens of both, or none."""
    if not text:
        return [], []
    a, b = libraries
    byte_of = {s: i for i, s in byte_symbols().items()}
    sides = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids], []
    for i in b.encode(text):
        sides[1].append((i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
        return [], []
    out = []
    for side in sides:
        end, found = 0, []
        for i, x in side:
            end += len(x)
            found.append((i, end))
        out.append(found)
    return out


def brute_force(texts, libraries):
    """The measures of each text, in order, and the counts of pairs."""
    split = [tokens_of(t, libraries) for t in texts]
    links = [[(i, j) for i, e in a for j, f in b if e == f] if len(a) < 400 else linked(a, b) for a, b in split]
    counts = Counter(p for found in links for p in found)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (a, b), found in zip(split, links):
        ends, shown = sorted({e for _, e in a} & {e for _, e in b}), []
        left, right = list(reversed(a)), list(reversed(b))
        for e in ends:
            shown.append("|".join(",".join(upto(side, e)) for side in (left, right)))
        sha = hashlib.sha256(";".join(shown).encode()).hexdigest() if shown else ""
        out.append(
            (len(a), len(b), len(ends), len(found), sum(counts[p] == most[p[1]] for p in found), sum(counts[p] for p in found), sha)
        )
    return out, counts


def upto(side, end):
    """Take the ids of the tokens that end by ``end`` from a reversed list."""
    out = []
    while side and side[-1][1] <= end:
        out.append(str(side.pop()[0]))
    return out


def linked(a, b):
    at = {f: j for j, f in b}
    return [(i, at[e]) for i, e in a if e in at]


def compare(got, texts, libraries):
    want, counts = brute_force([t for _, t in texts], libraries)
    got = {r["doc_id"]: r for r in got}
    assert len(got) == len(texts)
    for (i, _), w in zip(texts, want, strict=True):
        assert (*(got[i][c] for c in alignment.MEASURES), got[i]["groups_sha256"]) == w
    return counts


def test_the_query_by_plain_counting(spark, libraries):
    texts = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_alignment"](spark, FOLDER)
    assert got.columns == ["doc_id", *alignment.MEASURES, "groups_sha256"]
    compare(got.collect(), texts, libraries)


TEXTS = [
    None,
    "",
    " ",
    "a",
    "▁",
    "a ▁b",
    "two  blanks and\ttabs\n\nlines ",
    " leading",
    "ﬁ Ünï 日本 🙂 é ​\x00 ¼",
    "<s> </s> <unk> <0x41> <|endoftext|> plain",
    "it's 1234567 o'clock",
    "copy of a text",
    "copy of a text",
    "copy of a text",
]


def test_texts_of_all_kinds(spark, libraries):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_A int, key string").repartition(3)
    got, counts = alignment.align(df, *FILES)
    assert got.columns == ["doc_id", "key", *alignment.MEASURES, "groups_sha256"]
    want = compare(got.collect(), [r[:2] for r in rows], libraries)
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == want


def test_parts_of_long_texts(libraries, monkeypatch):
    both = alignment.aligner(open(FILES[0]).read(), open(FILES[1], "rb").read())
    text = "It's 12 o'clock,  don't go.\n Über é x and some plain words in a row " * 60
    ((a, b),) = both.tokenize([text])
    monkeypatch.setattr(alignment, "parts", lambda t: parts(t, 100))
    ((c, d),) = both.tokenize([text])
    assert a.tolist() == c.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
    assert b.tolist() == d.tolist() == libraries[1].encode(text)


def test_pairs_are_bounded_by_the_vocabularies():
    both = alignment.aligner(open(FILES[0]).read(), open(FILES[1], "rb").read())
    ends_b = Counter(both.bytes_b)
    pairs = sum(ends_b[x[i:]] for x in both.bytes_a for i in range(len(x)))
    ends_a = Counter(both.bytes_a)
    pairs += sum(ends_a[x[i:]] for x in both.bytes_b for i in range(1, len(x)))
    assert pairs < both.lengths_a.sum() + both.lengths_b.sum()


def test_no_rows_and_none_with_tokens(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert [x.count() for x in alignment.align(none, *FILES)] == [0, 0]
    one, counts = alignment.align(spark.createDataFrame([(None, None)], "doc_id long, text string"), *FILES)
    assert tuple(one.first()) == (None, 0, 0, 0, 0, 0, 0, "") and counts.count() == 0


def test_ids_of_remembered_pieces_are_the_librarys(libraries, monkeypatch):
    """Each different piece goes to the library once; forgetting them changes nothing."""
    from test_text_rows import texts

    every = [" " + t for t in [*texts(), "Ünï çodé ß the the's 'rest  \n\n x", "the same " * 50]]
    want = [libraries[0].encode(t, add_special_tokens=False).ids for t in every]
    both = alignment.aligner(alignment.read_text(FILES[0]), open(FILES[1], "rb").read())
    assert [x.tolist() for x in both.encode_a(every)] == want
    assert both.by_pieces and " same" in both.known
    monkeypatch.setattr(alignment, "KNOWN_PIECES", 0)
    assert [x.tolist() for i in range(0, len(every), 50) for x in both.encode_a(every[i : i + 50])] == want

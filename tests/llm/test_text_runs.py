"""Periodic runs against the definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tabkit.llm import runs
from tabkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def runs_by_definition(w, least=6, times=4):
    """Every stretch with a period that no neighbour continues, under its smallest period."""
    found, n = {}, len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def answer(doc_id, text):
    w = planted(doc_id, text)
    found = runs_by_definition(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = sha("".join("%d,%d,%d\n" % r for r in found))
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, lines, sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("least,times", [(6, 4), (4, 2), (9, 3), (1, 2)])
def test_runs_by_the_definition(least, times):
    rnd, rule = random.Random(5), runs.Rule(least, times)
    texts = [[], [1], [1] * 40, [1, 2] * 15 + [1], [1, 1, 2] * 9 + [3] + [1, 1, 2] * 9]
    for _ in range(400):
        word = lambda: rnd.randrange(rnd.choice([1, 2, 3]) + 1)
        w = []
        while len(w) < rnd.randrange(70):
            w += [word() for _ in range(rnd.randrange(1, 6))] * rnd.choice([1, 1, 2, 4, 5, 9])
        texts.append(w)
    bounds = np.cumsum([0, *map(len, texts)])
    got = runs.runs_of(np.array(sum(texts, []), np.int64), bounds, rule)
    want = [(s + b, length, q) for b, w in zip(bounds.tolist(), texts) for s, length, q in runs_by_definition(w, least, times)]
    assert [tuple(r) for r in got.tolist()] == want


def test_long_powers_and_many_classes_take_little_time():
    rule = runs.Rule(6, 4)
    word = np.zeros(200_000, np.int64)
    assert runs.runs_of(word, np.array([0, len(word)]), rule).tolist() == [[0, 200_000, 1]]
    blocks = np.concatenate([[i + 1] + [0] * 300 for i in range(300)])
    assert len(runs.runs_of(blocks, np.array([0, len(blocks)]), rule)) == 300
    square = np.tile(np.arange(5000), 40)
    assert runs.runs_of(square, np.array([0, len(square)]), rule).tolist() == [[0, 200_000, 5000]]


ROWS = [
    (1, "a b a b a b a b x", "k"),
    (1, "a b a b a b a b x", "k"),
    (None, "z " * 9, None),
    (2, None, "k"),
    (3, "", "k"),
    (4, " \t\n\x0b\x0c\r", "k"),
    (5, "     " * 8, "k"),
    (6, "one " * 20_000 + "two", "k"),
    *[(i, " ".join(f"w{j % (i % 7 + 2)}" for j in range(i % 40)), "k") for i in range(10, 90)],
]


def test_texts_of_all_kinds(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, Runs string").repartition(3)
    got = runs.find_runs(df, collapsed="kept")
    assert got.columns == ["doc_id", "text", "runs", "kept"]
    for r in got.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        found = [(0, 20_000, 1)] if len(w) > 10_000 else runs_by_definition(w)
        assert [tuple(x) for x in r["runs"]] == found
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        assert r["kept"] == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_ends_are_planted_by_the_id(spark):
    rows = [(i, f"x{i}  b\tc d e f g h", 0) for i in range(200)] + [(None, "a  b", 0), (36, None, 0), (36, " ", 0)]
    got = runs.with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string, extra int")).collect()
    assert [(r["doc_id"], (r["text"] or "").split()) for r in got] == [(i, planted(i, t)) for i, t, _ in rows]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(200)) > 10 and got[-3]["text"] == "a  b"


def test_the_query_by_the_definition(spark):
    got = QUERIES["op11_runs"](spark, FOLDER)
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in got.collect()) == sorted(answer(*r) for r in texts)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_no_rows(spark):
    assert runs.find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0

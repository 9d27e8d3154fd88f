"""Fingerprints, repeats, near-duplicates and shards against brute force."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash

from tabkit.llm import fingerprints, graph, repeats, shards, simhash, similar

DOCS = "doc_id long, text string, lang string"


def documents(n=60, seed=3):
    """Copies, near copies, shared passages, nulls, blanks, a long text, one id twice."""
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["Ünï", "日本", "A-b", "x"]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage = text(30)
    out = []
    for i in range(n):
        t = text(rnd.choice([1, 4, 7, 12, 13, 14, 40, 90]))
        if i % 5 == 0:
            t = t + "\n" + passage + "\t" + text(3)
        if i % 7 == 3 and out:
            t = rnd.choice(out)[1]
        if i % 7 == 5 and out and out[-1][1]:
            w = out[-1][1].split(" ")
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        out.append((i * 3, t, "en"))
    out += [(1, None, "en"), (2, "", None), (4, " \t\n", "de"), (7, text(5000), "de"), (None, passage, "fr")]
    return out + [out[10], out[10]]


@pytest.fixture(scope="module")
def rows_():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows_):
    return spark.createDataFrame(rows_, DOCS).repartition(4).cache()


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


# -- fingerprints ---------------------------------------------------------------------------------


def chained(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def syncmers(text, k, s):
    """(position, hash) by the definition."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")]
    if len(h) < k:
        return [(0, chained(h))] if h else []
    out = []
    for i in range(len(h) - k + 1):
        inner = [h[j] if s == 1 else chained(h[j : j + s]) for j in range(i, i + k - s + 1)]
        if min(map(signed, inner)) in (signed(inner[0]), signed(inner[-1])):
            out.append((i, chained(h[i : i + k])))
    return out


@pytest.mark.parametrize("k,s", [(8, 2), (5, 1), (4, 2)])
def test_anchors_are_closed_syncmers(docs, rows_, k, s):
    got = fingerprints.with_anchors(docs.select("text").distinct(), k=k, s=s).collect()
    assert len(got) == len({t for _, t, _ in rows_})
    for r in got:
        assert [(a["position"], a["hash"] & (1 << 64) - 1) for a in r["anchors"]] == syncmers(r["text"], k, s)


def test_every_stretch_of_tokens_has_an_anchor(docs):
    for r in fingerprints.with_anchors(docs.filter("length(text) > 200")).collect():
        at = [a["position"] for a in r["anchors"]]
        assert max(b - a for a, b in zip(at, at[1:])) <= fingerprints.K - fingerprints.S


def mark(text):
    """What rows of one id are ordered by: 31 bits of the text's hash."""
    return xxhash.xxh64((text or "").encode(), seed=42).intdigest() % (1 << 31)


def test_edits_take_the_next_document(docs, rows_):
    got = fingerprints.compare_with_edits(docs).collect()
    order = sorted(((i is not None, i or 0, mark(t), t or "") for i, t, _ in rows_))
    want = []
    for n, (known, i, _, t) in enumerate(order):
        following = order[(n + 1) % len(order)][3]
        half = len(t) // 2
        want.append((i if known else None, len(t), t[: len(t) - half] + following[:half]))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


@pytest.mark.parametrize("shuffle", [2, 1000])
@pytest.mark.parametrize("kind", ["apart", "hot", "far"])
def test_neighbours_for_any_number_of_blocks(spark, kind, shuffle):
    ids = {
        "apart": list(range(0, 9000, 3)),
        "hot": [None] * 700 + [5] * 900 + [6, 6, 7] + list(range(10, 400)),
        "far": [-(1 << 63), (1 << 63) - 1, (1 << 63) - 2, None, 0, 1, 1],
    }[kind]
    texts = [(i, f"t{n % 800}") for n, i in enumerate(ids)]
    order = sorted(((i is not None, i or 0, mark(t), t) for i, t in texts))
    want = [(i if known else None, t, order[(n + 1) % len(order)][3]) for n, (known, i, _, t) in enumerate(order)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        df = spark.createDataFrame(texts, "id long, text string").repartition(3)
        got = [tuple(r) for r in fingerprints.beside_next(df, "id", "text").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_plan_does_not_grow_with_the_blocks(spark):
    df = spark.range(5000).selectExpr("id", "cast(id as string) as text")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = []
    try:
        for n in (8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plan = fingerprints.beside_next(df, "id", "text")._jdf.queryExecution().analyzed()
            sizes.append(str(plan.numberedTreeString()).count("split("))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sizes[0] == sizes[1]


def test_likeness_of_equal_and_empty_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, ""), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.digest_columns(fingerprints.compare_with_edits(df)).collect()}
    assert got[1]["fingerprint"] == got[2]["fingerprint"] != ""
    assert got[1]["near_next"] == 1 and got[2]["near_next"] == 0 and got[3]["near_next"] == 1
    assert got[3]["fingerprint"] == got[4]["fingerprint"] == ""


def test_positions_of_shared_anchors(spark):
    from pyspark.sql import functions as F

    shared = " ".join("s%d" % i for i in range(40))
    df = spark.createDataFrame([("a b c " + shared, shared + " z")], "one string, other string")
    df = fingerprints.with_anchors(fingerprints.with_anchors(df, "one", "x"), "other", "y")
    pairs = df.select(fingerprints.shared_anchors(F.col("x"), F.col("y"))).first()[0]
    assert pairs and all(p["one"] - p["other"] == 3 for p in pairs)


def test_fingerprints_of_nothing_and_of_one(spark):
    assert fingerprints.compare_with_edits(empty(spark)).count() == 0
    one = fingerprints.compare_with_edits(spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")).first()
    assert (one["edited"], one["near_next"]) == ("ab ab", 1.0)
    replaced = fingerprints.with_anchors(spark.createDataFrame([("a", 1)], "text string, Anchors int"))
    assert replaced.columns == ["text", "anchors"] and len(replaced.first()["anchors"]) == 1
    odd = spark.createDataFrame([(1, "a", "x", 2), (2, "b", "y", 3)], "id int, text string, block string, key int")
    assert {(r["id"], r["next_text"], r["block"], r["key"]) for r in fingerprints.beside_next(odd, "id", "text").collect()} == {
        (1, "b", "x", 2), (2, "a", "y", 3)
    }


# -- repeats --------------------------------------------------------------------------------------


def repeated(rows, window):
    """n_words and the kept words by the definition."""
    first = {}
    split = [(-(1 << 63) if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), row in zip(split, rows, strict=True):
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < i for q in range(p, p + window)}
        out.append((row[0], len(w), " ".join(x for q, x in enumerate(w) if q not in gone), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,run", [(13, 5), (5, 5), (3, 1)])
def test_repeats_by_the_definition(docs, rows_, window, run):
    found = repeats.keep_words(repeats.find_repeats(docs, window=window, run=run))
    got = sorted(((r["doc_id"], r["n_words"], r["kept"], r["n_removed"]) for r in found.collect()), key=repr)
    assert got == repeated(rows_, window)
    assert found.columns[:3] == ["doc_id", "text", "lang"]


def test_repeats_in_very_many_copies(spark):
    rows = [(i, "the same line of words in all of them " * 3 + f"but {i} differs") for i in range(400)]
    found = repeats.keep_words(repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    got = sorted((r["doc_id"], r["n_words"], r["kept"], r["n_removed"]) for r in found.collect())
    assert got == sorted(repeated(rows, 13))


def test_words_that_differ_in_late_bytes_only_are_different(spark):
    one, other = (" ".join(f"subscription{i}{j}" for j in range(10)) + f" internationalisation{i} word-{'x' * 3000}{i} end" for i in (0, 4))
    found = repeats.find_repeats(spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string"))
    assert [r["n_removed"] for r in repeats.keep_words(found).collect()] == [0, 0]
    powers = repeats._powers(5000)
    assert powers.dtype == np.uint64 and (powers & np.uint64(1)).all() and len(set(powers.tolist())) == 5000


def test_factors_are_greedy_and_reach_over_boundaries():
    found = np.array([1, 1, 0, 0, 1, 0, 1], bool)
    assert repeats.factors(found, 3) == [(0, 4), (4, 7), (6, 9)]
    assert repeats.factors(np.zeros(4, bool), 3) == []


def test_repeats_of_nothing_and_clashes(spark):
    assert repeats.keep_words(repeats.find_repeats(empty(spark))).count() == 0
    odd = spark.createDataFrame([(1, "a", 2, "k")], "doc_id long, text string, Factors int, kept string")
    assert repeats.keep_words(repeats.find_repeats(odd)).columns == ["doc_id", "text", "n_words", "factors", "kept", "n_removed"]


def test_sketches_differ_in_no_more_bits_than_sets():
    rnd = np.random.default_rng(2)
    for shared, more in ((500, 40), (0, 3), (3000, 900), (10, 0)):
        x = rnd.integers(-(1 << 62), 1 << 62, shared + more)
        y = np.concatenate([x[:shared], rnd.integers(-(1 << 62), 1 << 62, more)])
        apart = sum(int(v).bit_count() for v in (similar.sketch(x) ^ similar.sketch(y)).view(np.uint64))
        assert apart <= 2 * more and apart % 2 == 0 and (apart > 0) == (more > 0)
    assert not similar.sketch(np.zeros(0, np.int64)).any()


# -- SimHash --------------------------------------------------------------------------------------


def simhash_of(text, words=3):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_linked_fingerprints_are_those_of_all_pairs(spark, radius):
    rnd = random.Random(radius)
    marks = {0}
    for _ in range(40):
        m = rnd.getrandbits(64)
        for _ in range(6):
            marks.add(m)
            for _ in range(rnd.randint(1, 3)):
                m ^= 1 << rnd.randrange(64)
    marks = sorted(signed(m) for m in marks)
    found = simhash.links(spark.createDataFrame([(m,) for m in marks * 2], "fingerprint long"), radius)
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    assert all(near(r["a"], r["b"]) for r in found.collect())
    roots = {r["node"]: r["root"] for r in graph.connected_components(found.select("a", "b")).collect()}
    assert {m: roots.get(m, m) for m in marks} == components(marks, near)


def test_simhash_components_of_documents(docs, rows_):
    got = simhash.near_duplicates(docs).collect()
    mark = {t: simhash_of(t) for _, t, _ in rows_}
    distinct = sorted(set(mark.values()))
    roots = components(distinct, lambda a, b: (a ^ b).bit_count() <= 2)
    name = {}
    for i, t, _ in rows_:
        if i is not None:
            r = roots[mark[t]]
            name[r] = min(name.get(r, i), i)
    want = [(i, mark[t], name.get(roots[mark[t]])) for i, t, _ in rows_]
    assert sorted(((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty(spark)).columns == ["doc_id", "text", "lang"]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 7), (7, 7)]
    star = [(1000 + i, 999) for i in range(300)]
    got = {r["node"]: r["root"] for r in graph.connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[1000 + i] for i in range(300)} == {999}
    assert 5 not in got


def jaccard(a, b, words=5):
    def shingles(t):
        w = t.lower().split()
        return {" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_one_of_each_group_of_similar_texts_stays(spark):
    rnd = random.Random(9)
    rows, n = [], 0
    for _ in range(25):
        base = ["v%d" % rnd.randrange(4000) for _ in range(rnd.choice([60, 150, 400]))]
        for _ in range(rnd.choice([1, 2, 4])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2])):
                w[rnd.randrange(len(w))] = "new%d" % rnd.randrange(10**6)
            rows.append((n, " ".join(w), "x"))
            n += 1
    rows += [(n, rows[0][1].upper(), "x"), (n + 1, None, "x"), (n + 2, " ", "x"), rows[4], rows[4]]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, row_key string"))
    assert kept.columns == ["doc_id", "text", "row_key"]
    got = sorted(r["doc_id"] for r in kept.collect())
    ids = sorted({i for i, _, _ in rows})
    text = {i: t or "" for i, t, _ in rows}
    roots = components(ids, lambda a, b: jaccard(text[a], text[b]) >= 0.8)
    assert got == sorted(set(roots.values()))


def kept_by_brute_force(rows):
    roots = components(sorted(i for i, _, _ in rows), lambda a, b: jaccard(rows[a][1], rows[b][1]) >= 0.8)
    return sorted(set(roots.values()))


@pytest.mark.parametrize("common", [0, 50, 500_000])
def test_cut_and_block_replaced_copies_are_all_found(spark, monkeypatch, common):
    monkeypatch.setattr(similar, "COMMON", common)
    rnd, rows = random.Random(4), []
    add = lambda w: rows.append((len(rows), " ".join(w), "x"))
    line = ["common%d" % i for i in range(12)]
    for n in (100, 400):
        for k in range(40):
            base = ["d%dx%d" % (len(rows), i) for i in range(n - 12)]
            base[n // 3 : n // 3] = line
            add(base)
            share = 0.795 + k % 20 * 0.005
            if k % 2:  # cut short: similarity is the share of the shingles
                add(base[: round(share * (n - 4)) + 4])
            else:  # one block replaced
                lost = round((1 - share) / (1 + share) * (n - 4)) - 4
                at = rnd.randrange(4, n - lost - 4)
                add([*base[:at], *("y%dx%d" % (len(rows), i) for i in range(lost)), *base[at + lost :]])
    likeness = [jaccard(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)]
    assert sum(x >= 0.8 for x in likeness) > 60 and min(likeness) < 0.8 < sum(likeness) / len(likeness) < 0.9
    want = sorted(i for i in range(len(rows)) if i % 2 == 0 or likeness[i // 2] < 0.8)
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()) == want


def test_copies_beside_a_smaller_id_of_the_same_words_are_found(spark):
    rnd = random.Random(6)
    words = ["w%d" % i for i in range(100)]
    swapped = [*words[:50], words[51], words[50], *words[52:]]
    rows = [(0, " ".join(rnd.sample(words, 100)), "x"), (1, " ".join(words), "x"), (2, " ".join(swapped), "x")]
    # a template all have, and copies of some of its uses
    template = ["t%d" % i for i in range(80)]
    for i in range(60):
        own = ["u%d" % (i // 3)] * 8 + ["u%dx%d" % (i // 3, j) for j in range(20 + i % 3)]
        rows.append((len(rows), " ".join([*template, *own]), "x"))
    assert kept_by_brute_force(rows)[:2] == [0, 1] and 2 not in kept_by_brute_force(rows)
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in got.collect()) == kept_by_brute_force(rows)


def test_texts_with_one_id_are_judged_one_by_one(spark):
    def text(name, changed=None):
        return " ".join(changed if changed and i == 30 else f"{name}{i}" for i in range(60))

    rows = [(3, text("a"), "x"), (7, text("a", "new"), "x"), (7, text("b"), "x"), (9, text("b", "new"), "x"), (7, text("c"), "x"),
            (None, text("d"), "x"), (None, text("d", "new"), "x"), (None, text("e"), "x"), (5, text("e", "new"), "x")]
    kept = [(r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()]
    assert len(kept) == 5
    assert {(3, text("a")), (7, text("b")), (7, text("c")), (None, text("e"))} <= set(kept)
    assert len({(None, text("d")), (None, text("d", "new"))} & set(kept)) == 1


# -- shards ---------------------------------------------------------------------------------------


def test_shards_hold_groups_together_and_are_even(docs, rows_):
    got = shards.shard_by_bytes(docs, 4).collect()
    assert len(got) == len(rows_)
    shard_of, loads, slots = {}, [0] * 4, {}
    for r in got:
        assert shard_of.setdefault(r["text_key"], r["shard"]) == r["shard"]
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    size = {}
    for _, t, _ in rows_:
        key = hashlib.sha256((t or "").encode()).digest()
        size[key] = size.get(key, 0) + len((t or "").encode()) + 1
    assert sum(loads) == sum(size.values())
    assert max(loads) <= max(max(size.values()), sum(loads) / 4 + sorted(size.values())[-2])


def test_differencing_beats_arrival_order_and_keeps_every_group():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 10_000) for _ in range(3000)]
    to = shards.difference([[s] + [0] * 15 for s in sizes])
    loads = [0] * 16
    for s, t in zip(sizes, to, strict=True):
        assert sorted(t) == list(range(16))
        loads[t[0]] += s
    assert sum(loads) == sum(sizes) and max(loads) - min(loads) <= 2
    assert shards.difference([]) == [] and shards.difference([[7, 3]]) == [[0, 1]]


def differenced(vectors):
    """Karmarkar-Karp by the definition on lists of (load, what it is made of); ties go to the earlier list."""
    heap = [sorted(v, key=lambda x: -x[0]) for v in vectors]
    heap = [(n, v) for n, v in enumerate(heap)]
    while len(heap) > 1:
        heap.sort(key=lambda x: (x[1][-1][0] - x[1][0][0], x[0]))
        (_, one), (_, other), *heap = heap
        sums = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(one, reversed(other), strict=True)]
        heap.append((len(vectors) + 1_000_000 - len(heap), sorted(sums, key=lambda x: -x[0])))
    return heap[0][1]


def test_differencing_is_that_of_the_definition():
    rnd = random.Random(6)
    sizes = [rnd.choice([1, 5, 5, 40, rnd.randint(1, 900)]) for _ in range(120)]
    want = differenced([[(s, [i])] + [(0, [])] * 4 for i, s in enumerate(sizes)])
    loads = [0] * 5
    for s, t in zip(sizes, shards.difference([[s] + [0] * 4 for s in sizes]), strict=True):
        loads[t[0]] += s
    assert loads == [w for w, _ in want]


@pytest.mark.parametrize("block, vectors", [(20, 100), (20, 3), (5000, 5000)])
def test_small_blocks_are_differenced_again(spark, block, vectors):
    groups = spark.range(1000).selectExpr("cast(cast(id as string) as binary) as k", "id + 1 as n")
    got = shards.assign_groups(groups, "k", "n", 8, block=block, vectors=vectors).collect()
    loads = [0] * 8
    for r in got:
        loads[r["shard"]] += int(r["k"]) + 1
    assert len({bytes(r["k"]) for r in got}) == len(got) == 1000 and max(loads) - min(loads) <= sum(loads) / 8 / 100


def test_shards_do_not_depend_on_the_order_of_arrival(spark, monkeypatch):
    monkeypatch.setattr(shards.assign_groups, "__defaults__", (50, 3))
    ties = spark.range(700).selectExpr("id as doc_id", "concat('t', id % 450) as text", "'en' as lang")
    results = []
    for df in (ties.repartition(3), ties.repartition(7, "text"), ties.orderBy(ties.doc_id.desc()).coalesce(1)):
        results.append(sorted((r["doc_id"], r["shard"], r["slot"]) for r in shards.shard_by_bytes(df, 16).collect()))
    assert results[0] == results[1] == results[2]


def test_shards_of_nothing(spark):
    assert shards.shard_by_bytes(empty(spark)).count() == 0


def test_the_sampled_order_of_shingles_decides_no_group(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:50] + [f"x{i}"]) for i in range(4)] + [" ".join(words[10:]), " ".join(reversed(words)), "w0 w1 w2 w3 w4 other words here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = []
    for least, common in ((10_000, 500_000), (1, 500_000), (1, 0)):  # all texts, one in four, no order but that of hashes
        monkeypatch.setattr(similar, "SAMPLE_LEAST", least)
        monkeypatch.setattr(similar, "COMMON", common)
        kept.append(sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs, words=5, similarity=0.8).collect()))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) < len(texts)

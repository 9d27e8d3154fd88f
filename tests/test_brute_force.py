"""Random small tables with a hot value and nulls, against plain Python."""

import collections
import math
import random

import pytest

from tabkit.operators import aggregate, joins, order, shape
from tabkit.operators.categories import CategoryStats, FrequencyIndexer, ModeImputer, TargetMeanEncoder, encode
from tabkit.runtime import Limits

WORDS = [None, "a", "b", "zz", "", "missing", "é", "a b", *[f"w{i}" for i in range(20)]]
SMALL = Limits(rows=1)  # nothing fits, so that the paths for large tables run


@pytest.fixture(params=[(1, 5, Limits()), (2, 200, Limits()), (3, 200, SMALL)], ids=["few", "many", "large"])
def case(request, spark, monkeypatch):
    seed, n, limits = request.param
    monkeypatch.setattr(order, "_COPIES_PER_TASK", 7)
    rng = random.Random(seed)
    hot = rng.choice(WORDS)
    data = [
        (
            i,
            hot if rng.random() < 0.4 else rng.choice(WORDS),
            rng.choice([None, 0, -5, 7, rng.randrange(1000)]),
            rng.choice([None, 1.5, -2.0, 100.0]),
        )
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "id int, s string, v int, y double").repartition(3), limits


def filled(word):
    return "missing" if word is None else word


def test_rank(case):
    data, df, _ = case
    ranked = order.global_rank(df.select("s", "v"), [("v", "desc"), "s"]).orderBy("rank").collect()
    want = sorted(((d[1], d[2]) for d in data), key=lambda r: (r[0] is not None, (r[0] or "").encode()))
    want.sort(key=lambda r: (r[1] is not None, r[1] or 0), reverse=True)
    assert [(r["s"], r["v"]) for r in ranked] == want
    assert [r["rank"] for r in ranked] == list(range(1, len(data) + 1))


def test_collect(case):
    data, df, _ = case
    groups = collections.defaultdict(list)
    for _, s, v, _ in data:
        if v is not None:
            groups[s].append(v)
    want = {(s, i // 10): sorted(vs)[i : i + 10] for s, vs in groups.items() for i in range(0, len(vs), 10)}
    got = {(r["s"], r["chunk"]): r["values"] for r in aggregate.collect_by_key(df, "s", "v", 10).collect()}
    assert got == want


def test_lookup(spark, case, rows):
    data, df, limits = case
    known = {w: i for i, w in enumerate(WORDS[1:9])}
    dim = spark.createDataFrame([*known.items(), (None, 99)], "s string, w int")
    want = sorted(((d[0], known.get(d[1])) for d in data), key=repr)
    assert rows(joins.lookup_join(df, dim, "s", limits), "id", "w") == want


def test_difference(case):
    data, df, _ = case
    got = shape.subtract(df.select("s", "v"), df.filter("id % 3 = 0").select("s", "v")).collect()
    want = {(d[1], d[2]) for d in data} - {(d[1], d[2]) for d in data if d[0] % 3 == 0}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_codes(spark, case):
    data, df, limits = case
    stats = CategoryStats.fit(df.na.fill("missing", ["s"]), ["s"], "y", limits=limits)
    index = FrequencyIndexer(["s"], "keep").from_stats(stats)
    mean = TargetMeanEncoder(["s"], "y").from_stats(stats)
    words = [*WORDS, "new"]
    test = spark.createDataFrame([(w,) for w in words], "s string")
    got = {r["s"]: r for r in encode(test, index, mean).collect()}

    counts = collections.Counter(filled(d[1]) for d in data)
    ranked = sorted(counts, key=lambda w: (-counts[w], w.encode()))
    labels = [d[3] for d in data if d[3] is not None]
    prior = sum(labels) / len(labels)
    for word in words:
        known = word is not None and word in counts
        assert got[word]["s_index"] == (ranked.index(word) if known else len(counts))
        own = [d[3] for d in data if filled(d[1]) == filled(word) and d[3] is not None]
        weight = 1 / (1 + math.exp(len(own) - 1)) if own else 1.0
        posterior = sum(own) / len(own) if own else 0.0
        assert got[word]["s_target"] == pytest.approx(weight * prior + (1 - weight) * posterior)

    imputer = ModeImputer(["s"]).fit(df)
    known = imputer.replace_unseen(imputer.transform(test.selectExpr("s", "s AS was"))).collect()
    assert {r["was"]: r["s"] for r in known} == {w: w if w in counts else ranked[0] for w in words}

"""Leaf-wise trees against trees grown one leaf at a time in plain Python, and against level-wise ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabkit.operators import learn, leafwise, search

FOLDER = "/root/testdata/sf0.001"


def by_hand(rows, trees, leaves, rate, leaf_rows):
    """Predictions of best-first trees over all values of all features; rows are ((features), label)."""
    y = [r[1] for r in rows]
    guess = [sum(y) / len(y)] * len(y)
    value = lambda i, f: math.inf if rows[i][0][f] is None or math.isnan(rows[i][0][f]) else rows[i][0][f]
    for _ in range(trees):
        g = [a - b for a, b in zip(y, guess)]
        score = lambda part: sum(g[i] for i in part) ** 2 / len(part)  # noqa: E731, B023

        def best(part):
            found = (0.0, None)
            for f in range(len(rows[0][0])):
                for e in sorted({value(i, f) for i in part}):
                    left, right = [i for i in part if value(i, f) < e], [i for i in part if value(i, f) >= e]  # noqa: B023
                    if min(len(left), len(right)) >= leaf_rows:
                        gain = score(left) + score(right) - score(part)  # noqa: B023
                        if gain > found[0] + 1e-7:
                            found = (gain, (left, right))
            return found

        parts = [(list(range(len(y))), best(range(len(y))))]
        while len(parts) < leaves:
            i = max(range(len(parts)), key=lambda i: parts[i][1][0])  # noqa: B023
            if not parts[i][1][1]:
                break
            parts[i : i + 1] = [(p, best(p)) for p in parts[i][1][1]]
        for part, _ in parts:
            for i in part:
                guess[i] += rate * sum(g[j] for j in part) / len(part)
    return guess


def made_rows(n=160):
    rnd = random.Random(8)
    out = []
    for _ in range(n):
        x = [rnd.randrange(6), rnd.choice([0, 1, None]), rnd.choice([1.5, 2.5, math.nan]), 7]
        out.append((x, 10 * x[0] ** 2 + (25 if x[1] is None else 40 * x[1]) * (x[0] > 2) + rnd.random()))
    return out


@pytest.mark.parametrize("leaves,trees,leaf_rows", [(1, 2, 1), (2, 3, 1), (6, 3, 1), (9, 2, 12), (500, 1, 1)])
def test_trees_are_grown_best_leaf_first(spark, leaves, trees, leaf_rows):
    rows = made_rows()
    df = spark.createDataFrame([(i, *map(lambda v: None if v is None else float(v), x), y) for i, (x, y) in enumerate(rows)], "i int, a double, b double, c double, d double, label double").repartition(3)
    model = leafwise.fit_leafwise(df, list("abcd"), trees=trees, leaves=leaves, rate=0.7, leaf_rows=leaf_rows)
    got = [r["prediction"] for r in model.transform(df).orderBy("i").collect()]
    assert got == pytest.approx(by_hand(rows, trees, leaves, 0.7, leaf_rows), rel=1e-6)
    assert all(len(list(t.leaves())) <= leaves for t in model.trees)
    assert model.importance()[3] == 0 and sum(model.importance()) == pytest.approx(float(leaves > 1))


def test_not_worse_than_level_wise_trees_of_as_many_leaves(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_quantity").cast("double"), F.col("l_discount").cast("double"), F.col("l_tax").cast("double"),
        F.col("l_partkey").cast("double"),
        (F.pow("l_quantity", F.lit(2)) * (1 - 4 * F.col("l_discount")) + F.pmod("l_partkey", F.lit(7))).cast("double").alias("label"),
    )
    rows = learn.assemble(lines, lines.columns[:-1])
    # the first of the level-wise trees has its whole weight whatever the step, so all have
    level = learn.fit_gbt(rows, maxIter=6, maxDepth=3, stepSize=1.0)
    leaf = leafwise.fit_leafwise(rows, trees=6, leaves=8, rate=1.0, leaf_rows=1)
    assert learn.rmse(leaf.transform(rows)) <= learn.rmse(level.transform(rows))
    names = lines.columns[:-1]
    table = leafwise.importance_table(rows, leaf, names).collect()
    assert {r["feature"] for r in table} == set(names) and sum(r["importance"] for r in table) == pytest.approx(1)
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)


def test_no_rows_no_labels_no_features(spark):
    schema = "a double, label double"
    for rows in ([], [(1.0, None)]):
        model = leafwise.fit_leafwise(spark.createDataFrame(rows, schema), ["a"], trees=2)
        assert [r["prediction"] for r in model.transform(spark.createDataFrame([(5.0, 1.0)], schema)).collect()] == [0.0]
    model = leafwise.fit_leafwise(spark.createDataFrame([(1.0, 4.0), (1.0, 6.0), (None, None)], schema), ["a"], trees=3, leaf_rows=1)
    assert [r["prediction"] for r in model.transform(spark.createDataFrame([(None, 1.0)], schema)).collect()] == [5.0]
    with pytest.raises(ValueError):
        leafwise.fit_leafwise(spark.createDataFrame([], schema), ["a"], leaves=0)


def test_search_scores_as_fits_of_their_own(spark):
    rows = made_rows(150) + [([2, 1, 1.5, 7], None), ([2, 1, 1.5, 7], 3.0)]
    folds = [i % 3 for i in range(151)] + [None]
    data = [(*map(lambda v: None if v is None else float(v), x), y, f) for (x, y), f in zip(rows, folds)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, label double, fold int").repartition(4)
    names = ["a", "b", "c", "d"]
    values = {"trees": [0, 1, 3], "leaves": [1, 4], "rate": [0.3], "leaf_rows": [1, 15], "penalty": [0.0, 2.0]}
    got = search.cross_validate_leafwise(df, values, names, folds=3, fold_col="fold").collect()
    assert [{k: r[k] for k in search.DEFAULTS} for r in got] == search.points(values)
    assert sum(r["is_best"] for r in got) == 1 and min(got, key=lambda r: r["rmse"])["is_best"]
    known = df.filter("label IS NOT NULL AND fold IS NOT NULL").cache()
    for point in (0, 5, 14, 15, 20, 23):
        settings = search.points(values)[point]
        errors = []
        for f in range(3):
            model = leafwise.fit_leafwise(known.filter(known.fold != f), names, **settings)
            errors.append(learn.rmse(model.transform(known.filter(known.fold == f))))
        assert got[point]["rmse"] == pytest.approx(sum(errors) / 3, rel=1e-6), settings


def test_search_reads_once_for_all_fits(spark, monkeypatch):
    calls = []
    read = search._histograms
    monkeypatch.setattr(search, "_histograms", lambda *a: calls.append(1) or read(*a))
    data = [(float(i % 7), float(i % 5), float(i * i % 31), i % 3) for i in range(300)]
    df = spark.createDataFrame(data, "a double, b double, label double, fold int")
    passes = []
    for rates in ([0.1], [0.1, 0.2, 0.5]):
        calls.clear()
        search.cross_validate_leafwise(df, {"trees": [2], "leaves": [2], "rate": rates}, ["a", "b"], fold_col="fold")
        passes.append(len(calls))
    assert passes[0] == passes[1]


def test_search_over_nothing_and_wrong_settings(spark):
    empty = spark.createDataFrame([], "a double, label double")
    assert [(r["rmse"], r["is_best"]) for r in search.cross_validate_leafwise(empty, {"trees": [1, 2]}, ["a"]).collect()] == [(None, False)] * 2
    one = spark.createDataFrame([(1.0, 2.0)], "a double, label double")
    assert search.cross_validate_leafwise(one, {"trees": [1]}, ["a"]).first()["rmse"] is None
    copies = spark.createDataFrame([(1.0, 2.0)] * 5 + [(float(i), 3.0) for i in range(9)], "a double, label double")
    assert search.cross_validate_leafwise(copies, {"trees": [0]}, ["a"]).first()["rmse"] > 0
    with pytest.raises(ValueError, match="depth"):
        search.cross_validate_leafwise(one, {"depth": [1]}, ["a"])

import contextlib
import io
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabkit.operators.categories import (
    MISSING,
    CategoryStats,
    FrequencyIndexer,
    ModeImputer,
    TargetMeanEncoder,
    _fit_together,
    encode,
)
from tabkit.runtime import Limits


@pytest.fixture
def train(spark):
    data = [("a", "x", 10.0), ("a", "y", 20.0), ("b", "y", 40.0), ("a", None, 30.0), ("c", "y", None)]
    return spark.createDataFrame(data, "p string, q string, v double")


@pytest.fixture
def test(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "z", "w"), (4, None, "y"), (5, "c", "y")], "id int, p string, q string")


def test_stats(train, rows):
    stats = CategoryStats.fit(train, ["p", "q"], "v")
    assert stats.vocabulary == {"p": 3, "q": 2}
    assert rows(stats.of("q"), "value", "n", "label_n", "label_sum") == [("x", 1, 1, 10.0), ("y", 3, 2, 60.0), (None, 1, 1, 30.0)]
    assert stats.prior == 25.0
    assert stats.modes() == {"p": "a", "q": "y"}


def test_stats_of_nothing(train):
    stats = CategoryStats.fit(train.limit(0), ["p", "q"], "v")
    assert stats.vocabulary == {"p": 0, "q": 0} and stats.prior is None and stats.modes() == {}


def test_mode_imputer(train, test, rows):
    imputer = ModeImputer(["p", "q"]).fit(train)
    filled = imputer.transform(test)
    assert rows(filled, "id", "p", "q") == [(1, "a", "x"), (2, "b", "y"), (3, "z", "w"), (4, "a", "y"), (5, "c", "y")]
    known = imputer.replace_unseen(filled)
    assert known.columns == test.columns
    assert rows(known) == [(1, "a", "x"), (2, "b", "y"), (3, "a", "y"), (4, "a", "y"), (5, "c", "y")]


def test_missing_can_be_the_mode(spark, rows):
    train = spark.createDataFrame([(None,), (None,), ("a",)], "p string")
    imputer = ModeImputer(["p"]).fit(train)
    assert rows(imputer.transform(spark.createDataFrame([(None,)], "p string"))) == [("missing",)]


def test_target_mean(train, test):
    encoded = TargetMeanEncoder(["p", "q"], "v").fit(train).transform(test)
    assert encoded.columns == ["id", "p", "q", "p_target", "q_target"]
    got = {r["id"]: (r["p_target"], r["q_target"]) for r in encoded.collect()}

    def shrunk(n, mean):
        weight = 1 / (1 + math.exp(n - 1))
        return weight * 25.0 + (1 - weight) * mean

    assert got[1] == (pytest.approx(shrunk(3, 20.0)), pytest.approx(shrunk(1, 10.0)))
    assert got[2] == (pytest.approx(shrunk(1, 40.0)), pytest.approx(shrunk(1, 30.0)))  # null is "missing"
    assert got[3] == (25.0, 25.0)  # unseen
    assert got[4][0] == 25.0
    assert got[5][0] == 25.0  # seen, but never with a label
    assert got[5][1] == pytest.approx(shrunk(2, 30.0))


def test_weight_of_a_large_category(spark):
    train = spark.range(5000).select(F.lit("a").alias("p"), F.lit(3.0).alias("v"))
    train = train.unionByName(spark.createDataFrame([("b", 9.0)], "p string, v double"))
    assert TargetMeanEncoder(["p"], "v").fit(train).transform(train).filter("p = 'a'").first()["p_target"] == 3.0


@pytest.mark.parametrize("limits", [Limits(), Limits(rows=2)])
def test_index_agrees_with_mllib(spark, limits):
    df = spark.range(2000).select(
        "id",
        F.concat(F.lit("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 41)).alias("p"),
        F.concat(F.lit("w"), F.col("id") % 7).alias("q"),
    )
    stats = CategoryStats.fit(df, ["p", "q"], limits=limits)
    ours = FrequencyIndexer(["p", "q"]).from_stats(stats).transform(df)
    mllib = StringIndexer(inputCols=["p", "q"], outputCols=["p_index", "q_index"]).fit(df).transform(df)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, mllib.collect()))


def test_index_keep(train, test):
    indexer = FrequencyIndexer(["p", "q"], invalid="keep").fit(train)
    got = {r["id"]: (r["p_index"], r["q_index"]) for r in indexer.transform(test).collect()}
    assert got == {1: (0.0, 1.0), 2: (1.0, 2.0), 3: (3.0, 2.0), 4: (3.0, 0.0), 5: (2.0, 0.0)}


@pytest.mark.parametrize("bad", ["z", None])
def test_index_error(spark, train, bad):
    indexer = FrequencyIndexer(["p"]).fit(train)
    assert indexer.transform(train).count() == 5
    with pytest.raises(PySparkException, match="unseen p"):
        indexer.transform(spark.createDataFrame([(bad,)], "p string")).collect()
    with pytest.raises(ValueError):
        FrequencyIndexer(["p"], invalid="skip")


def test_large_vocabulary_is_not_broadcast(spark, train, test, rows):
    small = CategoryStats.fit(train, ["p", "q"], "v")
    large = CategoryStats.fit(train, ["p", "q"], "v", limits=Limits(rows=1))
    assert not any(large.small.values())
    for fitted in (FrequencyIndexer(["p", "q"], "keep"), TargetMeanEncoder(["p", "q"], "v")):
        assert rows(fitted.from_stats(large).transform(test)) == rows(fitted.from_stats(small).transform(test))


def test_encoders_share_a_lookup(train, test, rows):
    stats = CategoryStats.fit(train, ["p", "q"], "v")
    indexer = FrequencyIndexer(["p", "q"], "keep").from_stats(stats)
    encoder = TargetMeanEncoder(["p", "q"], "v").from_stats(stats)
    both = encode(test, indexer, encoder)
    assert rows(both) == rows(encoder.transform(indexer.transform(test)))
    with pytest.raises(ValueError):
        encode(test, indexer, TargetMeanEncoder(["p", "q"], "v").fit(train))


def test_broadcast_budget_covers_all_columns():
    limits = Limits(rows=100, bytes=10)
    sizes = {**{f"c{i}": (1, 9) for i in range(6)}, "long": (101, 1), "wide": (1, 11), "tiny": (1, 1)}
    small = _fit_together(sizes, limits)
    assert small["tiny"] and not small["long"] and not small["wide"]
    assert sum(small[f"c{i}"] for i in range(6)) == 4


def test_large_lookups_move_the_table_once(spark):
    rows = [(i, f"p{i % 40}", None if i % 7 == 0 else f"q{i % 3}", i % 90, "same") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, p string, q string, r int, s string")
    seen = []
    for cols in (["p"], ["p", "q", "r", "s"]):
        stats = CategoryStats.fit(df, cols, "i", limits=Limits(rows=0), missing=MISSING)
        coded = encode(df, FrequencyIndexer(cols, invalid="keep").from_stats(stats), TargetMeanEncoder(cols, "i").from_stats(stats))
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            coded.explain()
        seen.append((text.getvalue().count("Exchange hashpartitioning"), text.getvalue().count("Exchange hashpartitioning(__row")))
        small = CategoryStats.fit(df, cols, "i", missing=MISSING)
        same = encode(df, FrequencyIndexer(cols, invalid="keep").from_stats(small), TargetMeanEncoder(cols, "i").from_stats(small))
        assert sorted(map(repr, coded.collect())) == sorted(map(repr, same.collect()))
    # the table and the codes by row, however many columns
    assert seen[0] == seen[1] and seen[0][1] == 2

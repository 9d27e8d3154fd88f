import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabkit.operators import aggregate
from tabkit.operators.categories import CategoryStats
from tabkit.operators.shape import drop_constant, subtract, union_all

SALES = [("pear", 9), ("fig", -5), ("pear", 4), ("pear", None), ("fig", 8), (None, 3)]


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_int_mean(spark, rows):
    df = spark.createDataFrame(SALES, "k string, n int")
    assert rows(aggregate.int_mean_by_key(df, "k", "n")) == [("fig", 1), ("pear", 6), (None, 3)]
    negative = spark.createDataFrame([("a", -3), ("a", -4)], "k string, n int")
    assert rows(aggregate.int_mean_by_key(negative, "k", "n")) == [("a", -3)]


def test_min_max_of_union(spark, rows):
    both = union_all(ints(spark, [17, None, -40, 17]), ints(spark, [260, 0]))
    assert both.count() == 6
    assert rows(aggregate.min_max(both, "v")) == [(-40, 260)]


def test_collect_by_key(spark, rows):
    df = spark.createDataFrame(SALES, "k string, n int")
    assert rows(aggregate.collect_by_key(df, "k", "n", 10)) == [("fig", 0, [-5, 8]), ("pear", 0, [4, 9]), (None, 0, [3])]


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_chunks_hold_the_same_values_whatever_their_size(spark, chunk):
    df = spark.createDataFrame(SALES, "k string, n int")
    got = {}
    for r in sorted(aggregate.collect_by_key(df, "k", "n", chunk).collect(), key=lambda r: (str(r["k"]), r["chunk"])):
        got[r["k"]] = got.get(r["k"], []) + r["values"]
    assert got == {"fig": [-5, 8], "pear": [4, 9], None: [3]}


def test_collect_by_key_in_chunks(spark):
    hot = spark.range(1000).select(F.lit("hot").alias("k"), F.pmod("id", F.lit(300)).alias("n"))
    null = spark.range(25).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("n"))
    cold = spark.range(3).select(F.lit("cold").alias("k"), F.col("id").alias("n"))
    df = union_all(hot, cold, null).repartition(5)
    got = {(r["k"], r["chunk"]): r["values"] for r in aggregate.collect_by_key(df, "k", "n", 64).collect()}
    want = {"hot": sorted(i % 300 for i in range(1000)), "cold": [0, 1, 2], None: list(range(25))}
    for key, values in want.items():
        chunks = [got.pop((key, c)) for c in range(-(-len(values) // 64))]
        assert [v for c in chunks for v in c] == values
        assert all(len(c) == 64 for c in chunks[:-1])
    assert not got


def test_count_and_mean_skip_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    assert rows(aggregate.count_and_mean(df, "k", "v")) == [("a", 1, 1.0), ("b", 0, None)]


def test_group_sum(spark, rows):
    df = spark.createDataFrame([("1", "S", 1.0), ("1", "S", 0.0), ("1", "C", 1.0), ("2", "S", 0.0)], "p string, e string, s double")
    assert rows(aggregate.group_sum(df, ["p", "e"], "s", "n")) == [("1", "C", 1.0), ("1", "S", 1.0), ("2", "S", 0.0)]


def test_crosstab(spark):
    df = spark.createDataFrame([(30, "m"), (9, "s"), (30, "s"), (30, "m"), (None, "m"), (9, None)], "age int, marital string")
    table = aggregate.crosstab(df, "age", "marital")
    assert table.columns == ["age_marital", "m", "null", "s"]
    assert [tuple(r) for r in table.collect()] == [("30", 2, 0, 1), ("9", 0, 1, 1), ("null", 1, 0, 0)]
    by_value = aggregate.crosstab(df, "age", "marital", numeric_order=True)
    assert [r[0] for r in by_value.collect()] == ["null", "9", "30"]
    # the same cells as Spark's own crosstab
    own = {r["age_marital"]: r.asDict() for r in df.stat.crosstab("age", "marital").collect()}
    assert own == {r["age_marital"]: r.asDict() for r in table.collect()}


def test_crosstab_of_given_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, c string")
    table = aggregate.crosstab(df, "k", "c", columns=["z", "w", "x"])
    assert [tuple(r) for r in table.select("k_c", "z", "w", "x").collect()] == [("1", 0, 0, 1), ("2", 1, 0, 0)]


def test_crosstab_of_very_many_values(spark):
    df = spark.range(12_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("c"))
    assert aggregate.pair_counts(df, "k", "c").filter("n = 1").count() == 12_000


def test_crosstab_refuses_two_columns_of_one_name(spark):
    with pytest.raises(ValueError):
        aggregate.crosstab(spark.createDataFrame([(1, "k_c")], "k int, c string"), "k", "c")


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "x int, y string")
    assert rows(aggregate.profile(df, ["x", "y"])) == [("x", 3, 0, 2), ("y", 3, 2, 1)]


def test_mode_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert rows(aggregate.mode_of(df, "v")) == [("a", 2)]
    assert rows(CategoryStats.fit(df, ["v"]).mode_table()) == [("v", "a", 2)]


def test_word_counts(spark):
    df = spark.createDataFrame([("blue sky over blue water",), ("over  and Over",)], ["t"])
    got = {r["word"]: r["count"] for r in aggregate.word_counts(df, "t").collect()}
    assert got == {"blue": 2, "sky": 1, "over": 2, "water": 1, "": 1, "and": 1, "Over": 1}


def test_word_counts_empty_fields(spark):
    df = spark.createDataFrame([(" a  b  ",), ("",), ("   ",), (None,)], ["t"])
    got = {r["word"]: r["count"] for r in aggregate.word_counts(df, "t").collect()}
    assert got == {"": 3, "a": 1, "b": 1}


def test_subtract_is_distinct_and_null_safe(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("z",)], "v string")
    b = spark.createDataFrame([("y",), (None,)], "v string")
    assert rows(subtract(a, b)) == [("x",), ("z",)]
    assert rows(subtract(b, a)) == []
    assert rows(subtract(a, b)) == rows(a.subtract(b))


def test_drop_constant(spark):
    train = spark.createDataFrame([("a", "x", None, None), ("a", "y", "n", None)], "one string, two string, part string, none string")
    kept_train, kept_test, kept = drop_constant(train, train, train.columns)
    assert kept == kept_train.columns == kept_test.columns == ["two", "part"]


@pytest.mark.parametrize("tracked, buckets", [(2, 3), (2, 4096), (64, 16)])
@pytest.mark.parametrize("skewed", [True, False])
def test_most_frequent_is_exact_whatever_the_sketch_says(spark, tracked, buckets, skewed):
    rnd = random.Random(4)
    draw = (lambda: int(rnd.paretovariate(0.6)) % 400) if skewed else (lambda: rnd.randrange(400))
    values = [(None if rnd.random() < 0.3 else f"v{draw():03}", rnd.choice([1, 1, 2, None])) for _ in range(6000)]
    df = spark.createDataFrame(values, "v string, n int").repartition(5)
    for k in (1, 3, 500):
        want = sorted(Counter(v for v, _ in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]
        got = aggregate.most_frequent(df, ["v"], k, tracked=tracked, buckets=buckets).collect()
        assert [tuple(r) for r in got] == want
    both = Counter(x for x in values if None not in x)
    want = sorted(both.items(), key=lambda x: (-x[1], x[0]))[:4]
    got = aggregate.most_frequent(df, ["v", "n"], 4, "rows", tracked, buckets).collect()
    assert [((r["v"], r["n"]), r["rows"]) for r in got] == want


def test_most_frequent_of_nothing_and_of_ties(spark, rows):
    assert rows(aggregate.most_frequent(spark.createDataFrame([], "v string"), ["v"], 3)) == []
    assert rows(aggregate.most_frequent(spark.createDataFrame([(None,)], "v string"), ["v"])) == []
    ties = spark.createDataFrame([(x,) for x in (0.0, -0.0, 2.0, 2.0, 1.0, 1.0, float("nan"))], "v double")
    assert [tuple(r) for r in aggregate.most_frequent(ties, ["v"], 2, tracked=1).collect()] == [(0.0, 2), (1.0, 2)]


def test_contingency_table_of_too_many_columns(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "MAX_COLUMNS", 3)
    four = spark.createDataFrame([("a", str(i)) for i in range(4)], "r string, c string")
    with pytest.raises(ValueError, match="pair_counts"):
        aggregate.crosstab(four, "r", "c")
    assert len(aggregate.crosstab(four, "r", "c", columns=["0", "1", "2", "3"]).columns) == 5
    assert len(aggregate.crosstab(four.limit(3), "r", "c").columns) == 4

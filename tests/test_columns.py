import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions import (
    TargetTransform,
    clamped_difference,
    cross,
    date_from_parts,
    day_gap,
    fill_template,
    guarded_ratio,
    number_or_sentinel,
    split_fields,
    years_since,
)
from tabkit.operators import features, missing, shape
from tabkit.sources import parse_lines

AS_OF = datetime.date(2020, 6, 30)


def one(spark, expr, **values):
    """Value of an expression over a single row."""
    fields = [T.StructField(k, t) for k, (v, t) in values.items()]
    row = tuple(v for v, _ in values.values())
    return spark.createDataFrame([row], T.StructType(fields)).select(expr).first()[0]


INT, DOUBLE, TEXT = T.IntegerType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    "text, sep, parts",
    [
        ("a,b", ",", ["a", "b"]),
        ("a,,b,,", ",", ["a", "", "b"]),
        (",a", ",", ["", "a"]),
        ("", ",", [""]),
        (",,", ",", []),
        ("a, b, ", ", ", ["a", "b"]),
        ("a|b.c", "|", ["a", "b.c"]),
        ("a..b", "..", ["a", "b"]),
        ("x \n", " ", ["x", "\n"]),
        ("x--\n--", "--", ["x", "\n"]),
        (None, ",", None),
    ],
)
def test_split_fields(spark, text, sep, parts):
    assert one(spark, split_fields(F.col("t"), sep), t=(text, TEXT)) == parts


def test_concat_of_parsed_lines(spark, rows):
    lines = spark.createDataFrame([("Jack, 15, 1111",), ("Andy, 30, 1111",)], ["line"])
    schema = T.StructType([T.StructField(n, TEXT) for n in ("name", "school", "student")])
    df = parse_lines(lines, "line", ", ", schema)
    assert rows(df.select(F.concat("school", "school"))) == [("1515",), ("3030",)]
    assert rows(df.select(F.concat("school", F.lit("_"), "school"))) == [("15_15",), ("30_30",)]
    assert rows(df.select(cross(["school", "school"]))) == [("15_15",), ("30_30",)]


def test_template(spark, rows):
    df = spark.createDataFrame([("Jack", 15), ("Mike", 26), ("Ann", None)], "name string, age int")
    got = rows(shape.format_rows(df, "Name: {} Age: {}", ["name", "age"]))
    assert got == [("Name: Jack Age: 15",), ("Name: Mike Age: 26",), (None,)]
    with pytest.raises(ValueError):
        fill_template("{}", ["a", "b"])


@pytest.mark.parametrize(
    "num, den, want",
    [(6.0, 3.0, 2.0), (6.0, 0.0, -9999.0), (None, 3.0, None), (6.0, None, None), (-9999.0, 3.0, -9999.0)],
)
def test_guarded_ratio(spark, num, den, want):
    expr = guarded_ratio(F.col("n"), F.col("d"), inputs=[F.col("n"), F.col("d")])
    assert one(spark, expr, n=(num, DOUBLE), d=(den, DOUBLE)) == want


def test_guarded_ratio_may_divide_the_sentinel(spark):
    assert one(spark, guarded_ratio(F.col("n"), F.col("d")), n=(-9999.0, DOUBLE), d=(3.0, DOUBLE)) == -3333.0


@pytest.mark.parametrize("a, b, want", [(5, 3, 2), (3, 5, 0), (None, 3, 0), (3, None, 0)])
def test_clamped_difference(spark, a, b, want):
    assert one(spark, clamped_difference(F.col("a"), F.col("b")), a=(a, INT), b=(b, INT)) == want


@pytest.mark.parametrize("text, want", [("NA", -9999.0), ("4.5", 4.5), ("x", None), (None, None)])
def test_number_or_sentinel(spark, text, want):
    assert one(spark, number_or_sentinel(F.col("t"), "NA"), t=(text, TEXT)) == want


@pytest.mark.parametrize(
    "year, month, want",
    [
        (2008, 2, datetime.date(2008, 2, 1)),
        (2008, 11, datetime.date(2008, 11, 1)),
        (2008, 13, None),
        (None, 3, None),
    ],
)
def test_date_from_parts(spark, year, month, want):
    assert one(spark, date_from_parts(F.col("y"), F.col("m")), y=(year, INT), m=(month, INT)) == want


def test_ages(spark):
    assert one(spark, years_since(F.col("y"), AS_OF), y=(2003, INT)) == 17.0
    assert one(spark, years_since(F.col("y"), AS_OF, -9999.0), y=(-9999.0, DOUBLE)) == -9999.0
    assert one(spark, day_gap(date_from_parts(F.col("y"), F.lit(3)), date_from_parts(F.col("y"))), y=(2004, INT)) == 60


def test_feature_columns(spark):
    df = spark.createDataFrame([(2005, 3, 1990, 4.0, 0.0, "a", None)], "y int, m int, b int, p double, q double, s string, t string")
    df = features.date_age(df, "y", "m", AS_OF, "age", {"since_built": "b"})
    df = features.year_age(df, "b", AS_OF, "house_age")
    df = features.ratio_feature(df, "p", "q", "r")
    df = features.sum_feature(df, ["p", "q"], "total")
    df = features.clamped_diff(df, "q", "p", "less")
    df = features.cross_feature(df, ["s", "t"])
    row = df.first()
    assert row["age"] == (AS_OF - datetime.date(2005, 3, 1)).days
    assert row["since_built"] == (datetime.date(2005, 3, 1) - datetime.date(1990, 1, 1)).days
    assert (row["house_age"], row["r"], row["total"], row["less"]) == (30.0, -9999.0, 4.0, 0.0)
    assert row["s_t"] == "a" and "s" not in df.columns and "t" not in df.columns


def test_target_round_trip(spark):
    df = spark.createDataFrame([(200.0, 8.0, -9999.0), (200.0, 8.0, 2.0)], "v double, a double, b double")
    target = TargetTransform("v", ("a", "b"))
    got = df.withColumn("l", target.forward()).select(F.expm1("l"), target.inverse("l")).collect()
    assert [round(r[0], 9) for r in got] == [25.0, 20.0]
    assert [round(r[1], 9) for r in got] == [200.0, 200.0]
    plain = TargetTransform("v")
    assert round(df.withColumn("l", plain.forward()).select(plain.inverse("l")).first()[0], 9) == 200.0


def test_replace_and_fill(spark, rows):
    df = spark.createDataFrame([("C (all)", "NA", 1), ("RL", "x", None)], "zone string, other string, n int")
    assert rows(missing.replace_values(df, ["zone", "other"], {"C (all)": "C", "NA": None})) == [("C", None, 1), ("RL", "x", None)]
    assert rows(missing.null_out(df, ["NA", "RL"])) == [("C (all)", None, 1), (None, "x", None)]
    # a column of another type is left alone
    assert rows(missing.replace_values(df, ["n", "zone"], {"RL": "R"}))[1] == ("R", "x", None)
    assert rows(missing.fill_numeric(df, -9999, ["n"]), "n") == [(-9999,), (1,)]
    assert rows(missing.fill_string(missing.null_out(df, ["NA"]), "missing", ["other"]), "other") == [("missing",), ("x",)]


def test_numeric_with_sentinel(spark, rows):
    df = spark.createDataFrame([("NA", "1"), ("65.5", "NA")], "a string, b string")
    assert rows(missing.numeric_with_sentinel(df, ["a", "b"])) == [(-9999.0, 1.0), (65.5, -9999.0)]


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b", 3)], "id int, x double, s string, label string, n int")
    assert shape.split_columns(df, exclude=("id", "label")) == (["x", "n"], ["s"])
    test = df.select("n", "s", "id", "x")
    assert shape.align_to(test, df, drop=("label",)).columns == ["id", "x", "s", "n"]


def test_cast_in_place_keeps_order(spark):
    df = shape.cast_columns(spark.createDataFrame([(1, "x", "3")], "a int, b string, c string"), {"a": "string", "b": "int", "c": "int"})
    assert df.columns == ["a", "b", "c"] and tuple(df.first()) == ("1", None, 3)


def test_conform_widens(spark):
    df = spark.createDataFrame([("RL", 60, 1, 0)], "zone string, kind int, id int, extra int")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("kind", T.LongType()), T.StructField("zone", T.StringType())])
    assert shape.conform(df, schema).schema.simpleString() == "struct<id:int,kind:bigint,zone:string>"


def test_continuous_metadata(spark):
    df = shape.as_continuous(spark.range(3), ["id"])
    assert df.schema["id"].metadata["ml_attr"]["type"] == "numeric"


def test_view_and_sql(spark, rows):
    shape.register(spark.createDataFrame([(26, 1, "A"), (18, 2, "B")], ["Id", "n", "s"]), "samples")
    assert rows(spark.sql("SELECT Id FROM samples")) == [(18,), (26,)]
    assert spark.table("samples").filter(F.col("Id") == 26).count() == 1

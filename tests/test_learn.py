import datetime
import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabkit.operators import learn
from tabkit.plans import bank_calls, house_sales, passengers, text_classifier
from tabkit.sources import read_csv, write_csv

AS_OF = datetime.date(2020, 6, 30)


def test_assemble_rejects_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="Encountered null"):
        learn.assemble(df, ["a", "b"]).collect()


def test_standardize_uses_the_training_table(spark):
    train = learn.assemble(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "a double"), ["a"])
    test = learn.assemble(spark.createDataFrame([(5.0,)], "a double"), ["a"])
    scaled_train, scaled_test = learn.standardize(train, test, "features")
    assert [r["scaled"][0] for r in scaled_train.collect()] == [-1.0, 0.0, 1.0]
    assert scaled_test.first()["scaled"][0] == 3.0


def test_one_hot(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    encoded, _ = learn.one_hot(df, df, ["i"])
    assert [list(r[0]) for r in encoded.select(vector_to_array("i_onehot")).collect()] == [[1, 0], [0, 1], [0, 0]]


def test_tokens(spark):
    df = spark.createDataFrame([("A b  C ",)], ["t"])
    assert learn.tokenize(df, "t").first()["words"] == ["a", "b", "", "c"]
    hashed = learn.hash_tf(learn.tokenize(df, "t"), "words", 10).first()["features"]
    assert hashed.size == 10 and sum(hashed.toArray()) == 4


def test_words_are_counted_in_their_own_buckets(spark):
    df = learn.hash_tf(learn.tokenize(spark.createDataFrame([("kite kite boat",), ("kite",), ("boat",)], ["t"]), "t"), "words", 1 << 12)
    both, kite, boat = [r["features"].toArray() for r in df.collect()]
    assert kite.sum() == boat.sum() == 1 and kite.argmax() != boat.argmax()
    assert (both == 2 * kite + boat).all()


def test_text_classifier(spark):
    data = [(i, "late delivery, box torn" if i % 2 else "fine and quick", float(i % 2)) for i in range(12)]
    df = spark.createDataFrame(data, "id int, text string, label double")
    scored = {r["id"]: r for r in text_classifier.classify(df, df).collect()}
    assert all(scored[i]["prediction"] == label for i, _, label in data)
    assert scored[1]["probability"] > 0.8 and scored[0]["probability"] < 0.2
    hashed = text_classifier.features(df).select("id", "features")
    again = {r["id"]: r for r in text_classifier.classify_hashed(hashed, df.select("id", "label")).collect()}
    assert all(abs(again[i]["probability"] - r["probability"]) < 1e-6 for i, r in scored.items())


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "label double, prediction double")
    assert learn.rmse(df) == pytest.approx(2.5**0.5)


def test_zip_columns(spark, rows):
    assert rows(learn.zip_columns(spark, ["a", "b"], [["x", "y"], [1, 2]])) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        learn.zip_columns(spark, ["a", "b"], [["x"], [1, 2]])


def test_search_and_importance(spark):
    df = spark.range(200).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("noise"))
    df = learn.assemble(df.withColumn("label", F.col("x") * 2), ["x", "noise"])
    estimator = learn.gbt(maxIter=2)
    assert len(learn.grid(estimator, {"maxIter": [2, 4], "maxDepth": [1, 2, 3], "stepSize": [0.1]})) == 6
    model = learn.cross_validate(df, estimator, {"maxDepth": [1, 3]}, folds=2, parallelism=2)
    assert learn.best_params(model, ["maxDepth", "maxBins"]) == {"maxDepth": 3, "maxBins": 128}
    table = learn.feature_importance(spark, model.bestModel, ["x", "noise"]).collect()
    assert [r["feature"] for r in table] == ["x", "noise"] and table[0]["importance"] > 0.9


def houses(spark, n, offset=0):
    """Made-up houses with every column the flow names."""
    i = F.col("id") + offset
    number = lambda k, m, base=0: (F.pmod(i * k, F.lit(m)) + base).cast("int")
    text = lambda k, *options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(i * k, F.lit(len(options))) + 1).cast("int"))
    sources = [c for cols in house_sales.CROSSES for c in cols] + ["KitchenQual", "FireplaceQu", "MasVnrType"]
    categories = {c: text(k + 3, "A", "B", "NA") for k, c in enumerate(dict.fromkeys(sources)) if c not in ("MSSubClass", "MSZoning")}
    counts = {c: number(k + 2, 900) for k, c in enumerate(house_sales.COUNT_COLUMNS)}
    areas = {c: number(k + 5, 700) for k, c in enumerate(["1stFlrSF", "2ndFlrSF", "LowQualFinSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch"])}
    columns = {
        "Id": i.cast("int"),
        "MSSubClass": number(1, 3, 20),
        "MSZoning": text(1, "RL", "C (all)"),
        **categories,
        **counts,
        **areas,
        "TotalBsmtSF": F.when(F.col("id") % 5 == 0, None).otherwise(number(3, 800)).cast("string"),
        "GrLivArea": number(13, 1500, 500),
        "LotArea": number(7, 9000) * F.when(F.col("id") % 4 == 0, 0).otherwise(1),
        "LotFrontage": F.when(F.col("id") % 3 == 0, "NA").otherwise(number(3, 90).cast("string")),
        "MasVnrArea": F.when(F.col("id") % 7 == 0, "NA").otherwise(number(3, 400).cast("string")),
        "GarageYrBlt": F.when(F.col("id") % 6 == 0, "NA").otherwise(number(3, 50, 1960).cast("string")),
        "BedroomAbvGr": number(1, 4),
        "KitchenAbvGr": number(1, 2),
        "TotRmsAbvGrd": number(1, 9),
        "Fireplaces": number(1, 3),
        "OverallQual": number(1, 9, 1),
        "OverallCond": number(2, 9, 1),
        "YearBuilt": number(3, 80, 1920),
        "YearRemodAdd": number(5, 60, 1950),
        "YrSold": number(1, 4, 2006),
        "MoSold": number(1, 12, 1),
        "SalePrice": number(311, 200000, 50000),
    }
    return spark.range(n).select(*[c.alias(name) for name, c in columns.items()])


@pytest.fixture(scope="module")
def house_tables(spark):
    test = houses(spark, 30, 1000).drop("SalePrice")
    unseen = F.when(F.col("Id") % 5 == 0, "Q").when(F.col("Id") % 5 == 1, None).otherwise(F.col("Street"))
    return houses(spark, 120).cache(), test.withColumn("Street", unseen).cache()


def test_feature_catalogue(spark, house_tables):
    train, _ = house_tables
    cleaned = house_sales.clean(train)
    derived = house_sales.derive(cleaned, AS_OF)
    new = [c for c in derived.columns if c not in cleaned.columns]
    assert len(new) == 14 + 27 + 4 + 1 + 3 + 3
    assert not set(house_sales.DROPPED) & set(derived.columns)
    row = derived.filter("Id = 4").first()
    source = cleaned.filter("Id = 4").first()
    assert row["DIVIDE(GrLivArea, LotArea)"] == -9999.0
    assert row["ADD(BsmtFinSF1, BsmtFinSF2)"] == source["BsmtFinSF1"] + source["BsmtFinSF2"]
    assert row["MSSubClass_MSZoning"] == f"{source['MSSubClass']}_{source['MSZoning']}"
    assert source["MSZoning"] in ("RL", "C")
    assert row["DateDiff(Now, YearBuilt)"] == 2020 - source["YearBuilt"]


def value_of(name, row):
    """What a feature name such as ``DIVIDE(a, ADD(b, c))`` says, computed from a row."""
    match = re.fullmatch(r"(ADD|DIVIDE)\((.*)\)", name)
    if not match:
        return row[name]
    parts = re.findall(r"ADD\([^)]*\)|[^, ]+", match[2])
    values = [value_of(p, row) for p in parts]
    if any(v is None for v in values):
        return None
    if match[1] == "ADD":
        return sum(values)
    return -9999.0 if values[1] == 0 else values[0] / values[1]


def test_features_are_what_their_names_say(house_tables):
    cleaned = house_sales.clean(house_tables[0])
    sources = {r["Id"]: r.asDict() for r in cleaned.collect()}
    derived = house_sales.derive(cleaned, AS_OF, pass_sentinel=False)
    names = [c for c in derived.columns if c.startswith(("ADD(", "DIVIDE("))]
    assert len(names) == 31
    for row in derived.select("Id", *names).collect():
        for name in names:
            assert row[name] == pytest.approx(value_of(name, sources[row["Id"]])), name


def test_missing_area_is_not_divided(spark, house_tables):
    cleaned = house_sales.clean(house_tables[0]).filter("Id = 7")
    name = "DIVIDE(MasVnrArea, LotArea)"
    assert house_sales.derive(cleaned, AS_OF).first()[name] == -9999.0
    lot = cleaned.first()["LotArea"]
    assert house_sales.derive(cleaned, AS_OF, pass_sentinel=False).first()[name] == -9999.0 / lot


@pytest.mark.parametrize("kind", ["encoded", "indexed", "standardised"])
def test_house_flow(spark, house_tables, tmp_path, kind):
    train, test = house_tables
    if kind == "standardised":
        prepared = house_sales.prepare_standardised(train, test)
    else:
        prepared = getattr(house_sales, f"prepare_{kind}")(train, test, AS_OF)
    assert "Id" not in prepared.names and "SalePrice" not in prepared.names
    model = house_sales.search(prepared, {"maxDepth": [2], "maxIter": [2]}, folds=2, parallelism=2).bestModel
    out = house_sales.submission(model, prepared)
    write_csv(out, str(tmp_path / "submission"))
    back = read_csv(spark, str(tmp_path / "submission"), infer=True)
    assert back.columns == ["Id", "SalePrice"] and back.count() == 30
    assert back.filter("SalePrice IS NULL OR SalePrice <= 0").count() == 0


def test_house_tables_from_csv(spark, house_tables, tmp_path):
    for name, df in zip(("train", "test"), house_tables):
        write_csv(df, str(tmp_path / name))
    train, test = house_sales.read(spark, str(tmp_path / "train"), str(tmp_path / "test"))
    assert dict(train.dtypes)["LotFrontage"] == "string" and train.count() == 120 and test.count() == 30
    prepared = house_sales.prepare_encoded(train, test, AS_OF)
    assert prepared.train.select("features").first()[0].size == len(prepared.names)


def test_survivors(spark, tmp_path, rows):
    header = "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked"
    lines = ['1,1,3,"A, Mr",male,,1,0,t,7.25,,S', '2,0,3,"B, Mr",male,22,1,0,t,7.25,,S', '3,1,1,"C, Mrs",female,30,0,0,t,80,C1,']
    path = tmp_path / "p.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    totals = passengers.survivors(passengers.read(spark, str(path)))
    assert rows(totals) == [("1", None, 1.0), ("3", "S", 1.0)]


def test_bank_calls(spark, tmp_path):
    names = list(bank_calls.Call.__dataclass_fields__)
    row = lambda age, marital: ";".join(
        str(age) if n == "age" else marital if n == "marital" else "5" if bank_calls.Call.__annotations__[n] == "float" else "unknown"
        for n in names
    )
    path = tmp_path / "calls.csv"
    path.write_text("\n".join([";".join(names), row(30, "single"), row(30, "married"), row(41, "unknown")]) + "\n")
    calls = bank_calls.read(spark, str(path))
    assert calls.filter("job IS NULL").count() == 3
    table = bank_calls.age_by_marital(calls)
    assert [tuple(r) for r in table.collect()] == [("30", 1, 0, 1), ("41", 0, 1, 0)]

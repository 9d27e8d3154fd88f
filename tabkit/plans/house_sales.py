"""Sale-price regression, end to end: clean, derive, encode, fit, score.

Three preparations of the same two tables are offered:

* `prepare_standardised` - scaled numbers next to one-hot categories;
* `prepare_encoded` - derived features, categories as index and as shrunken mean price;
* `prepare_indexed` - derived features, categories as index only.

Each returns a `Prepared`; `search` or `learn.fit_gbt` fits it and `submission` scores it.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.dates import date_from_parts, day_gap, years_since
from tabkit.functions.numeric import SENTINEL, clamped_difference, guarded_ratio, total
from tabkit.functions.target import TargetTransform
from tabkit.functions.text import cross
from tabkit.operators import learn
from tabkit.operators.categories import (
    MISSING,
    CategoryStats,
    FrequencyIndexer,
    ModeImputer,
    TargetMeanEncoder,
    encode,
)
from tabkit.operators.missing import fill_numeric, fill_string, null_out, numeric_with_sentinel, replace_values
from tabkit.operators.shape import align_to, as_continuous, cast_columns, drop_constant, split_columns
from tabkit.sources import read_csv

ID = "Id"
PRICE = "SalePrice"

# The columns of the sale-price tables, the tokens in them, the features derived
# from them and how those are named.
NULL_TOKEN = "NA"
NONE_TOKEN = "None"
ZONE_SPELLING = {"C (all)": "C"}
COUNT_COLUMNS = [
    "BsmtFinSF1",
    "BsmtFinSF2",
    "BsmtUnfSF",
    "TotalBsmtSF",
    "BsmtFullBath",
    "BsmtHalfBath",
    "GarageCars",
    "GarageArea",
]
SENTINEL_COLUMNS = ["LotFrontage", "MasVnrArea", "GarageYrBlt"]
CODES = ["MSSubClass"]
CODES_AND_PERIODS = ["MSSubClass", "OverallCond", "YrSold", "MoSold"]
CROSSES = [
    ["MSSubClass", "MSZoning"],
    ["Street", "Alley"],
    ["LandContour", "LandSlope"],
    ["LotShape", "LotConfig"],
    ["Neighborhood", "Condition1", "Condition2"],
    ["RoofStyle", "RoofMatl"],
    ["Exterior1st", "Exterior2nd"],
    ["ExterQual", "ExterCond"],
    ["BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2"],
    ["Heating", "HeatingQC"],
    ["GarageType", "GarageFinish", "GarageQual", "GarageCond"],
    ["SaleType", "SaleCondition"],
]
CROSSES_KEEPING_SOURCES = [["KitchenAbvGr", "KitchenQual"], ["Fireplaces", "FireplaceQu"]]
SUMS = [
    ["OverallQual", "OverallCond"],
    ["BsmtFinSF1", "BsmtFinSF2"],
    ["1stFlrSF", "2ndFlrSF"],
    ["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch"],
]
LOT = ["LotArea"]
BASEMENT = ["TotalBsmtSF"]
INDOOR = ["TotalBsmtSF", "GrLivArea"]
FINISHED = ["BsmtFinSF1", "BsmtFinSF2"]
FLOORS = ["1stFlrSF", "2ndFlrSF"]
ROOMS = ["TotRmsAbvGrd"]
RATIOS = [
    (["MasVnrArea"], [LOT, INDOOR]),
    (["BsmtFinSF1"], [LOT, BASEMENT, INDOOR]),
    (["BsmtFinSF2"], [LOT, BASEMENT, INDOOR]),
    (FINISHED, [LOT, BASEMENT, INDOOR]),
    (["BsmtUnfSF"], [BASEMENT, FINISHED, INDOOR]),
    (BASEMENT, [INDOOR]),
    (["1stFlrSF"], [LOT, INDOOR]),
    (["2ndFlrSF"], [["1stFlrSF"], LOT, INDOOR]),
    (FLOORS, [LOT]),
    (["LowQualFinSF"], [LOT]),
    (["GrLivArea"], [LOT, INDOOR]),
    (["BedroomAbvGr"], [ROOMS]),
    (["KitchenAbvGr"], [ROOMS]),
    (["GarageArea"], [["GarageCars"]]),
]
DROPPED = ["OverallQual", "OverallCond", "YearBuilt", "YearRemodAdd", "YrSold", "MoSold", "GarageYrBlt"]


@dataclass(frozen=True)
class Prepared:
    """Tables with a ``features`` vector; ``train`` also has the ``label``."""

    train: DataFrame
    test: DataFrame
    names: list[str]
    target: TargetTransform


def read(spark: SparkSession, train: str, test: str, null_value: str = "") -> tuple[DataFrame, DataFrame]:
    """Both tables from CSV with inferred types and one null token."""
    return (
        read_csv(spark, train, infer=True, null_value=null_value),
        read_csv(spark, test, infer=True, null_value=null_value),
    )


def _sum_name(cols: list[str]) -> str:
    return cols[0] if len(cols) == 1 else f"ADD({', '.join(cols)})"


def _sum(cols: list[str]) -> Column:
    return total([F.col(c) for c in cols])


def clean(df: DataFrame) -> DataFrame:
    """One spelling per zone, numbers as numbers, codes as text."""
    df = replace_values(df, ["MSZoning"], ZONE_SPELLING)
    df = null_out(df, [NULL_TOKEN], ["MasVnrType"])
    df = cast_columns(df, {**dict.fromkeys(COUNT_COLUMNS, "int"), **dict.fromkeys(CODES, "string")})
    return numeric_with_sentinel(cast_columns(df, dict.fromkeys(SENTINEL_COLUMNS, "string")), SENTINEL_COLUMNS, NULL_TOKEN)


def derive(df: DataFrame, as_of: datetime.date, pass_sentinel: bool = True) -> DataFrame:
    """The derived features of a cleaned table, in one projection, without their used-up sources.

    ``pass_sentinel`` lets a ratio of a missing measurement be missing too; otherwise the
    sentinel number is divided like any other.
    """
    sold = date_from_parts(F.col("YrSold"), F.col("MoSold"))
    built, remodelled = F.col("YearBuilt"), F.col("YearRemodAdd")
    features: dict[str, Column] = {"_".join(c): cross(c) for c in CROSSES + CROSSES_KEEPING_SOURCES}
    features.update({_sum_name(c): _sum(c) for c in SUMS})
    for num, dens in RATIOS:
        for den in dens:
            inputs = [F.col(c) for c in {*num, *den}] if pass_sentinel else None
            features[f"DIVIDE({_sum_name(num)}, {_sum_name(den)})"] = guarded_ratio(
                _sum(num), _sum(den), SENTINEL, inputs
            )
    features.update(
        {
            "SUB(YearRemodAdd, YearBuilt)": clamped_difference(remodelled, built),
            "DateDiff(Now, YearRemodAdd)": years_since(remodelled, as_of),
            "DateDiff(Now, YearBuilt)": years_since(built, as_of),
            "DateDiff(Now, GarageYrBlt)": years_since(F.col("GarageYrBlt"), as_of, SENTINEL),
            "DateDiff(Now, YrSoldMoSold)": day_gap(F.lit(as_of), sold),
            "DateDiff(YrSoldMoSold, YearBuilt)": day_gap(sold, date_from_parts(built)),
            "DateDiff(YrSoldMoSold, YearRemodAdd)": day_gap(sold, date_from_parts(remodelled)),
        }
    )
    return df.withColumns(features).drop(*[c for cols in CROSSES for c in cols], *DROPPED)


def _fill(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    return fill_string(fill_numeric(df, SENTINEL, numeric), MISSING, categorical)


def _assembled(train: DataFrame, test: DataFrame, target: TargetTransform) -> Prepared:
    names = [c for c in train.columns if c not in (ID, PRICE)]
    labelled = train.withColumn("label", target.forward())
    return Prepared(learn.assemble(labelled, names), learn.assemble(test, names), names, target)


def prepare_encoded(
    train: DataFrame, test: DataFrame, as_of: datetime.date, pass_sentinel: bool = True
) -> Prepared:
    """Derived features; every category becomes its index and its shrunken mean price.

    The statistics of all categories come from one pass over ``train``.
    """
    train, test = (derive(clean(df), as_of, pass_sentinel) for df in (train, test))
    numeric, categorical = split_columns(train, exclude=(ID, PRICE))
    train, test = _fill(train, numeric, categorical), _fill(test, numeric, categorical)
    stats = CategoryStats.fit(train, categorical, PRICE)
    indexer = FrequencyIndexer(categorical, invalid="keep").from_stats(stats)
    encoder = TargetMeanEncoder(categorical, PRICE).from_stats(stats)
    train, test = (
        as_continuous(encode(df, indexer, encoder), [f"{c}_index" for c in categorical]).drop(*categorical)
        for df in (train, test)
    )
    return _assembled(train, test, TargetTransform(PRICE, ("GrLivArea", "TotalBsmtSF")))


def prepare_indexed(train: DataFrame, test: DataFrame, as_of: datetime.date, pass_sentinel: bool = True) -> Prepared:
    """Derived features; every category becomes its index."""
    train, test = (derive(clean(df), as_of, pass_sentinel) for df in (train, test))
    numeric, categorical = split_columns(train, exclude=(ID, PRICE))
    train, test = fill_numeric(train, SENTINEL, numeric), fill_numeric(test, SENTINEL, numeric)
    indexer = FrequencyIndexer(categorical, invalid="keep").fit(train)
    train, test = (indexer.transform(df).drop(*categorical) for df in (train, test))
    train, test = (as_continuous(df, [f"{c}_index" for c in categorical]) for df in (train, test))
    return _assembled(train, test, TargetTransform(PRICE, ("GrLivArea",)))


def prepare_standardised(train: DataFrame, test: DataFrame) -> Prepared:
    """Scaled numbers and one-hot categories of the columns as they are."""
    train, test = null_out(train, [NONE_TOKEN]), null_out(test, [NONE_TOKEN])
    test = align_to(test, train, drop=(PRICE,))
    text = dict.fromkeys(CODES_AND_PERIODS, "string")
    train, test = cast_columns(train, text), cast_columns(test, text)
    numeric, categorical = split_columns(train, exclude=(ID, PRICE))

    train, test = (learn.assemble(fill_numeric(df, 0, numeric), numeric, "numbers") for df in (train, test))
    train, test = learn.standardize(train, test, "numbers", "scaled")

    train, test, categorical = drop_constant(train, test, categorical)
    imputer = ModeImputer(categorical).fit(train)
    train = fill_string(train, MISSING, categorical)
    test = imputer.replace_unseen(imputer.transform(test))
    indexer = FrequencyIndexer(categorical).from_stats(imputer.stats)
    train, test = indexer.transform(train), indexer.transform(test)
    train, test = learn.one_hot(train, test, [f"{c}_index" for c in categorical])

    target = TargetTransform(PRICE)
    inputs = ["scaled", *[f"{c}_index_onehot" for c in categorical]]
    labelled = train.withColumn("label", target.forward())
    return Prepared(learn.assemble(labelled, inputs), learn.assemble(test, inputs), numeric + categorical, target)


def search(
    prepared: Prepared, values: dict[str, list], folds: int = 3, parallelism: int = 8, max_bins: int = 128
) -> CrossValidatorModel:
    """Cross-validated search for the boosted trees with the lowest RMSE."""
    return learn.cross_validate(prepared.train, learn.gbt(max_bins=max_bins), values, folds, parallelism)


def submission(model: Model, prepared: Prepared) -> DataFrame:
    """(Id, SalePrice) of the test table."""
    return learn.score(model, prepared.test, ID, PRICE, prepared.target.inverse())

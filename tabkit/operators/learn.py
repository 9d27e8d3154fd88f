"""Feature vectors, models, selection and scoring on MLlib."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, OneHotEncoder, StandardScaler, Tokenizer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.runtime import persisted

# Rows a task should have at least, as far as the shuffle partitions allow.
TASK_ROWS = 16_384


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Columns to one vector column. A null in any of them is an error when the rows are read."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def standardize(
    train: DataFrame, test: DataFrame, col: str, out: str = "scaled"
) -> tuple[DataFrame, DataFrame]:
    """Scale a vector column to zero mean and unit sample deviation, as measured on ``train``."""
    scaler = StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True).fit(train)
    return scaler.transform(train), scaler.transform(test)


def one_hot(
    train: DataFrame, test: DataFrame, cols: list[str], suffix: str = "_onehot", drop_last: bool = True
) -> tuple[DataFrame, DataFrame]:
    """One indicator vector per index column; the last index is all zeros under ``drop_last``."""
    outs = [c + suffix for c in cols]
    encoder = OneHotEncoder(inputCols=cols, outputCols=outs, dropLast=drop_last).fit(train)
    return encoder.transform(train), encoder.transform(test)


def tokenize(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Lower-case and split at every whitespace character, without trailing empty words."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def hash_tf(df: DataFrame, col: str, n: int, out: str = "features") -> DataFrame:
    """Word counts hashed into ``n`` buckets."""
    return HashingTF(inputCol=col, outputCol=out, numFeatures=n).transform(df)


def fit_logistic(
    train: DataFrame, label: str = "label", features: str = "features", iterations: int = 10, reg: float = 0.01
) -> LogisticRegressionModel:
    return LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=iterations, regParam=reg
    ).fit(train)


def gbt(label: str = "label", features: str = "features", max_bins: int = 128, seed: int = 7, **params) -> GBTRegressor:
    """Gradient-boosted regression trees, not fitted yet."""
    return GBTRegressor(labelCol=label, featuresCol=features, maxBins=max_bins, seed=seed, **params)


def fit_gbt(train: DataFrame, **params) -> GBTRegressionModel:
    """Fit boosted trees."""
    estimator = gbt(**params)
    with persisted(_training_rows(train, estimator)) as kept:
        return estimator.fit(kept)


def _training_rows(train: DataFrame, estimator: GBTRegressor, *more: str) -> DataFrame:
    """The label and the vector, spread evenly: fitting reads them again and again."""
    rows = train.select(estimator.getLabelCol(), estimator.getFeaturesCol(), *more)
    return spread(rows, train.count())


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df``, that has so many ``rows``, in even partitions: few rows in few, as every pass starts a task for each."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(partitions, -(-rows // TASK_ROWS))))


def grid(estimator: Estimator, values: dict[str, list]) -> list:
    """All combinations of the given parameter values."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), options)
    return builder.build()


def cross_validate(
    train: DataFrame,
    estimator: GBTRegressor,
    values: dict[str, list],
    folds: int = 3,
    parallelism: int = 8,
    seed: int = 7,
    evaluator: Evaluator | None = None,
    fold_col: str | None = None,
) -> CrossValidatorModel:
    """k-fold search over the grid; only the label, the vector and the fold are cached meanwhile.

    ``fold_col`` holds the fold of each row, from 0 to ``folds`` - 1; without it folds are drawn.
    """
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid(estimator, values),
        evaluator=evaluator or RegressionEvaluator(metricName="rmse", labelCol=estimator.getLabelCol()),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
        **({"foldCol": fold_col} if fold_col else {}),
    )
    with persisted(_training_rows(train, estimator, *([fold_col] if fold_col else []))) as kept:
        return search.fit(kept)


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction).evaluate(df)


def zip_columns(spark: SparkSession, names: list[str], values: list[list]) -> DataFrame:
    """Equal-length lists side by side, one row per position. For model-sized lists."""
    if len({len(v) for v in values}) > 1:
        raise ValueError("lists of different lengths")
    return spark.createDataFrame(list(zip(*values)), names)


def feature_importance(spark: SparkSession, model: GBTRegressionModel, names: list[str]) -> DataFrame:
    """(feature, importance), most important first."""
    weights = [float(w) for w in model.featureImportances.toArray()]
    return zip_columns(spark, ["feature", "importance"], [names, weights]).orderBy(
        F.desc("importance"), "feature"
    )


def best_params(model: CrossValidatorModel, names: list[str]) -> dict[str, object]:
    """Parameter values of the winning model."""
    best = model.bestModel
    return {n: best.getOrDefault(best.getParam(n)) for n in names}


def score(model: Model, df: DataFrame, key: str, out: str, value: Column) -> DataFrame:
    """Predict, transform the prediction back with ``value``, keep the key and the result."""
    return model.transform(df).select(key, value.alias(out))

"""Text classification: tokens, hashed word counts, logistic regression."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.learn import fit_logistic, hash_tf, tokenize
from tabkit.runtime import persisted

BUCKETS = 10


def features(df: DataFrame, text: str = "text") -> DataFrame:
    return hash_tf(tokenize(df, text), "words", BUCKETS)


def classify_hashed(hashed: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Probability of label 1 for every row of ``hashed`` (key, features), learned from ``labels``.

    The vectors are joined with the labels, never the texts.
    """
    with persisted(hashed.join(labels.select(key, "label"), key).select("label", "features")) as ready:
        model = fit_logistic(ready)
    return model.transform(hashed).select(key, vector_to_array("probability")[1].alias("probability"), "prediction")


def classify(train: DataFrame, test: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Probability of label 1 for every row of ``test``; ``train`` has a double ``label``."""
    with persisted(features(train, text).select("label", "features")) as ready:
        model = fit_logistic(ready)
    scored = model.transform(features(test, text))
    return scored.select(key, vector_to_array("probability")[1].alias("probability"), F.col("prediction"))

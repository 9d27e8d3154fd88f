"""Age against marital status in a table of marketing calls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabkit.operators.aggregate import crosstab
from tabkit.operators.shape import conform
from tabkit.sources import read_csv


# The columns of the call table, in file order.
@dataclass
class Call:
    age: T.IntegerType
    job: str
    marital: str
    education: str
    credit_default: str
    housing: str
    loan: str
    contact: str
    month: str
    day_of_week: str
    duration: float
    campaign: float
    pdays: float
    previous: float
    poutcome: str
    emp_var_rate: float
    cons_price_idx: float
    cons_conf_idx: float
    euribor3m: float
    nr_employed: float
    y: str


def read(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated calls with inferred types, widened to `Call`."""
    return conform(read_csv(spark, path, infer=True, sep=";", null_value="unknown"), Call)


def age_by_marital(calls: DataFrame) -> DataFrame:
    return crosstab(calls, "age", "marital")

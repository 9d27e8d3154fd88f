"""Survivors per passenger class and port."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.operators.aggregate import group_sum
from tabkit.operators.shape import conform
from tabkit.sources import read_csv


# The columns of the passenger table, in file order.
@dataclass
class Passenger:
    PassengerId: float
    Survived: float
    Pclass: str
    Name: str
    Sex: str
    Age: float
    SibSp: float
    Parch: float
    Ticket: str
    Fare: float
    Cabin: str
    Embarked: str


@dataclass
class GroupTotal:
    Pclass: str
    Embarked: str
    Count: float


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema=Passenger, null_value="")


def survivors(passengers: DataFrame) -> DataFrame:
    totals = group_sum(passengers, ["Pclass", "Embarked"], "Survived", "Count")
    return conform(totals.select("Pclass", "Embarked", F.col("Count").cast("double")), GroupTotal)

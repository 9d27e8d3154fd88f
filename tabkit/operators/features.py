"""Derived feature columns. Each call adds its columns in one projection."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.dates import date_from_parts, day_gap, years_since
from tabkit.functions.numeric import SENTINEL, clamped_difference, guarded_ratio, total
from tabkit.functions.text import cross


def cross_feature(df: DataFrame, cols: list[str], sep: str = "_", drop: bool = True) -> DataFrame:
    """Join categories into one column named after them; nulls are skipped."""
    out = df.withColumn("_".join(cols), cross(cols, sep))
    return out.drop(*cols) if drop else out


def ratio_feature(df: DataFrame, num: str, den: str, out: str, sentinel: float = SENTINEL) -> DataFrame:
    return df.withColumn(out, guarded_ratio(F.col(num), F.col(den), sentinel))


def sum_feature(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    return df.withColumn(out, total([F.col(c) for c in cols]))


def clamped_diff(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, clamped_difference(F.col(a), F.col(b)))


def year_age(
    df: DataFrame, col: str, as_of: datetime.date, out: str, sentinel: float | None = None
) -> DataFrame:
    return df.withColumn(out, years_since(F.col(col), as_of, sentinel))


def date_age(
    df: DataFrame, year: str, month: str, as_of: datetime.date, out: str, others: dict[str, str]
) -> DataFrame:
    """Days from the event month to ``as_of`` (``out``) and from each year column to the event."""
    event = date_from_parts(F.col(year), F.col(month))
    ages = {name: day_gap(event, date_from_parts(F.col(c))) for name, c in others.items()}
    return df.withColumns({out: day_gap(F.lit(as_of), event), **ages})

"""Missing values: replacing, nulling out, filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.numeric import SENTINEL, number_or_sentinel


def replace_values(df: DataFrame, cols: list[str], mapping: dict[str, str | None]) -> DataFrame:
    """Replace values in string columns; a value of None stands for null."""
    return df.na.replace(mapping, subset=cols)


def null_out(df: DataFrame, tokens: list[str], cols: list[str] | None = None) -> DataFrame:
    """Turn sentinel texts into null in ``cols``, by default in every string column."""
    return df.na.replace({t: None for t in tokens}, subset=cols)


def numeric_with_sentinel(
    df: DataFrame, cols: list[str], token: str = "NA", sentinel: float = SENTINEL
) -> DataFrame:
    """Text columns to double, with ``token`` as the sentinel number."""
    return df.withColumns({c: number_or_sentinel(F.col(c), token, sentinel) for c in cols})


def fill_numeric(df: DataFrame, value: float, cols: list[str]) -> DataFrame:
    return df.na.fill(value, subset=cols) if cols else df


def fill_string(df: DataFrame, value: str, cols: list[str]) -> DataFrame:
    return df.na.fill(value, subset=cols) if cols else df

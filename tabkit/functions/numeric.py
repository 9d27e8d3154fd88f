"""Numeric expressions."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = -9999.0


def total(cols: list[Column]) -> Column:
    """Sum over columns; null when one of them is null."""
    return reduce(add, cols)


def guarded_ratio(
    num: Column, den: Column, sentinel: float = SENTINEL, inputs: list[Column] | None = None
) -> Column:
    """``num / den``, or the sentinel when ``den`` is zero.

    With ``inputs`` the sentinel also comes out whenever one of them is the sentinel, rather than
    being divided as if it were a measurement.
    """
    stop = den == 0
    if inputs:
        stop = reduce(or_, [c == sentinel for c in inputs], stop)
    return F.when(stop, F.lit(float(sentinel))).otherwise(
        F.try_divide(num.cast("double"), den.cast("double"))
    )


def clamped_difference(a: Column, b: Column) -> Column:
    """``a - b`` when positive, else 0 (also when either is null)."""
    return F.greatest(a - b, F.lit(0))


def number_or_sentinel(text: Column, token: str, sentinel: float = SENTINEL) -> Column:
    """Text to double; the missing-value ``token`` becomes the sentinel, other text null."""
    return F.when(text == token, F.lit(float(sentinel))).otherwise(text.try_cast("double"))


def int_mean(value: str) -> Column:
    """Aggregate: truncating integer mean of an integer column."""
    return F.expr(f"sum(`{value}`) div count(`{value}`)")

"""Date expressions. "Now" is always an argument, so that results can be repeated."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_parts(year: Column, month: Column | None = None) -> Column:
    """First day of the month (or of the year); null when a part is null or the parts are no date.

    Parts may be numbers of any type or text; fractions are cut off.
    """
    whole = lambda part: part.try_cast("double").try_cast("int")
    y, m = whole(year), F.lit(1) if month is None else whole(month)
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def day_gap(later: Column, earlier: Column) -> Column:
    """Days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)


def years_since(year: Column, as_of: datetime.date, sentinel: float | None = None) -> Column:
    """Age in years at ``as_of``; a ``sentinel`` year is passed through."""
    age = F.year(F.lit(as_of)).cast("double") - year.cast("double")
    return age if sentinel is None else F.when(year == sentinel, F.lit(float(sentinel))).otherwise(age)

from tabkit.functions.dates import date_from_parts, day_gap, years_since
from tabkit.functions.numeric import (
    clamped_difference,
    guarded_ratio,
    int_mean,
    number_or_sentinel,
    total,
)
from tabkit.functions.target import TargetTransform
from tabkit.functions.text import cross, fill_template, split_fields

__all__ = [
    "TargetTransform",
    "clamped_difference",
    "cross",
    "date_from_parts",
    "day_gap",
    "fill_template",
    "guarded_ratio",
    "int_mean",
    "number_or_sentinel",
    "split_fields",
    "total",
    "years_since",
]

"""Transform of a regression target and its inverse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabkit.functions.numeric import SENTINEL, total


@dataclass(frozen=True)
class TargetTransform:
    """``log1p(value / area)``, where area adds up ``parts`` and a sentinel part counts as 0.

    Without parts it is plain ``log1p(value)``.
    """

    value: str
    parts: tuple[str, ...] = ()
    sentinel: float = SENTINEL

    def area(self) -> Column:
        if not self.parts:
            return F.lit(1.0)
        return total([F.when(F.col(p) == self.sentinel, 0).otherwise(F.col(p)) for p in self.parts])

    def forward(self) -> Column:
        return F.log1p(F.try_divide(F.col(self.value).cast("double"), self.area().cast("double")))

    def inverse(self, prediction: str = "prediction") -> Column:
        return F.expm1(F.col(prediction)) * self.area()

"""String expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(text: Column, sep: str) -> Column:
    """Split on a literal separator, without trailing empty fields.

    Text that does not contain the separator is one field, also when it is empty.
    """
    pattern = re.escape(sep)
    if len(sep) == 1:
        kept = F.rtrim(text, F.lit(sep))
    else:
        kept = F.regexp_replace(text, rf"(?:{pattern})+\z", "")
    cut = F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, pattern))
    # cutting reads the whole text once more, and few texts end with the separator
    return F.when(F.endswith(text, F.lit(sep)), cut).otherwise(F.split(text, pattern))


def cross(cols: list[str], sep: str = "_") -> Column:
    """One category out of several: the values joined with ``sep``, nulls skipped."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def fill_template(template: str, cols: list[str]) -> Column:
    """Fill the ``{}`` places of ``template`` from columns; a null column makes the result null."""
    texts = template.split("{}")
    if len(texts) != len(cols) + 1:
        raise ValueError(f"{len(texts) - 1} places for {len(cols)} columns")
    parts = [F.lit(texts[0])]
    for col, after in zip(cols, texts[1:]):
        parts += [F.col(col).cast("string"), F.lit(after)]
    return F.concat(*parts)

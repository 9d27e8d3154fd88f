"""CSV scans, text-line scans and delimited strings."""

from __future__ import annotations

import dataclasses
import datetime
import typing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.text import split_fields

_SCALARS = {
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bool: T.BooleanType(),
    datetime.date: T.DateType(),
}


def schema_of(record: type) -> T.StructType:
    """Schema of a dataclass. Fields are nullable; annotate with a Spark type to override."""
    hints = typing.get_type_hints(record)
    return T.StructType([T.StructField(f.name, _spark_type(hints[f.name])) for f in dataclasses.fields(record)])


def from_records(spark: SparkSession, records: list, record: type) -> DataFrame:
    """Dataclass instances held in memory to a table."""
    return spark.createDataFrame([dataclasses.astuple(r) for r in records], schema_of(record))


def _spark_type(hint: object) -> T.DataType:
    if isinstance(hint, type) and issubclass(hint, T.DataType):
        return hint()
    if typing.get_origin(hint) is list:
        return T.ArrayType(_spark_type(typing.get_args(hint)[0]))
    options = [a for a in typing.get_args(hint) if a is not type(None)]
    if len(options) == 1:
        return _spark_type(options[0])
    try:
        return _SCALARS[hint]
    except KeyError:
        raise TypeError(f"no Spark type for {hint!r}") from None


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | type | None = None,
    infer: bool = False,
    sep: str = ",",
    null_value: str | None = None,
    nan_value: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    Columns are strings unless ``schema`` (a StructType or a dataclass) or ``infer`` is given; the
    schema wins over inference. Inference costs a pass over the files. ``null_value`` is the one
    token read as null; without it empty fields are null, and then ``nan_value=""`` has no effect.
    With it, an unquoted empty field is still null and a quoted one is empty text.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if nan_value is not None:
        reader = reader.option("nanValue", nan_value)
    if schema is not None:
        reader = reader.schema(schema if isinstance(schema, T.StructType) else schema_of(schema))
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_delimited_text(
    spark: SparkSession, path: str | list[str], sep: str, fields: dict[str, int], header: str | None = None
) -> DataFrame:
    """Text lines split on a literal ``sep``, with ``{name: position}`` picked as strings.

    Quoting is not understood; use `read_csv` for quoted files. Lines equal to ``header`` are
    dropped. A position the line does not have is null.
    """
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.filter(F.col("value") != header)
    parts = split_fields(F.col("value"), sep)
    return lines.select(*[F.get(parts, F.lit(at)).alias(name) for name, at in fields.items()])


def parse_lines(df: DataFrame, col: str, sep: str, schema: T.StructType) -> DataFrame:
    """Delimited strings to typed rows: split on a literal ``sep``, trim, cast by position.

    Text that does not parse as its field's type becomes null.
    """
    parts = split_fields(F.col(col), sep)
    return df.select(
        *[
            F.trim(F.get(parts, F.lit(at))).try_cast(field.dataType).alias(field.name)
            for at, field in enumerate(schema.fields)
        ]
    )

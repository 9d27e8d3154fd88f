"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.runtime import let_workers_import

# Bytes of one Arrow batch between the JVM and Python: bounds a worker's memory for long texts.
BATCH_BYTES = 2 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes."""
    let_workers_import(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(fn, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def make_room(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its columns of these names, whatever their case: an operator's own take their place."""
    gone = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in gone))


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def append(batch: pa.RecordBatch, schema: pa.Schema, *columns: pa.Array) -> pa.RecordBatch:
    """The batch's columns followed by ``columns``, under the names and types of ``schema``."""
    arrays = [*batch.columns, *columns]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def extended(df: DataFrame, *fields: tuple[str, T.DataType]) -> tuple[T.StructType, pa.Schema]:
    """Schema of ``df`` with more fields, for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
    return schema, to_arrow_schema(schema)

"""CSV and text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.layout import partition_number


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "error",
    sep: str = ",",
    null_value: str | None = None,
    files: int | None = None,
) -> None:
    """Write CSV with a header.

    ``files`` is the number of files, whatever the size: with 1 a single task writes everything.
    Without it every partition of ``df`` writes its own.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode(mode).option("header", True).option("sep", sep)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def write_text(
    df: DataFrame,
    path: str,
    *,
    line: str = "value",
    key: str | None = None,
    partitions: int = 10,
    mode: str = "error",
) -> None:
    """Write the string column ``line``, one row per line.

    With ``key`` a row goes to the folder ``part=<key mod partitions>``. Rows are rebalanced by
    folder first: adaptive execution gives a small folder one file and splits a large one over as
    many tasks as its size asks for, so that no task has to hold a whole partition.
    """
    lines = F.col(line).cast("string").alias("value")
    if key is None:
        df.select(lines).write.mode(mode).text(path)
    else:
        part = partition_number(F.col(key), partitions).alias("part")
        df.select(lines, part).hint("rebalance", F.col("part")).write.mode(mode).partitionBy("part").text(path)

"""Session helpers: shared scratch space, written intermediates, measured sizes, caching."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Limits:
    """What a table may measure and still be broadcast."""

    rows: int = 1_000_000
    bytes: int = 64 << 20

    def allow(self, rows: int, size: int | None) -> bool:
        return rows <= self.rows and (size or 0) <= self.bytes


DEFAULT_LIMITS = Limits()
_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A session without that setting gets a fresh temporary folder, but only in local mode: on a
    cluster a machine-local folder is invisible to the other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabkit-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch root, or the open `scratch_scope`, that nobody has used."""
    return f"{_SCOPE.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch folder and read it back.

    This cuts the lineage and survives lost executors; later readers prune its columns, and with
    ``partition_by`` its folders.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(schema: T.StructType) -> Column:
    """Approximate in-memory width of a row, as a column."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, _FIXED_WIDTH):
            return F.lit(8)
        text = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text = text.cast("string")
        return F.lit(16) + F.coalesce(F.octet_length(text), F.lit(0))

    return reduce(add, [width(f) for f in schema.fields], F.lit(8))


def fits_broadcast(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Measure ``df`` in one aggregate and say whether it is within ``limits``."""
    rows, size = df.agg(F.count("*"), F.sum(row_bytes(df.schema).cast("long"))).first()
    return limits.allow(rows, size)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Own the intermediates written inside the block, and delete them when it ends.

    Results are lazy: write or collect them before leaving. Scopes may be nested; an inner one deletes
    its own intermediates only.
    """
    path = scratch_path(spark, "scope")
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `scratch_path` named."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` cached inside the block. Run the actions that use it before leaving."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder this package was imported from on the Python path of the workers started from now on.

    Where executors do not see that folder, install the package there or give it as ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])

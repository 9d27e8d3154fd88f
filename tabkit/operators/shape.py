"""Schema-driven column handling and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.text import fill_template
from tabkit.sources.delimited import schema_of


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast_columns(df: DataFrame, types: dict[str, str | T.DataType]) -> DataFrame:
    """Cast columns in place; a value that does not convert becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def split_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Names of the (numeric, categorical) columns: a string column is categorical."""
    kept = [f for f in df.schema.fields if f.name not in exclude]
    categorical = [f.name for f in kept if isinstance(f.dataType, T.StringType)]
    return [f.name for f in kept if f.name not in categorical], categorical


def align_to(df: DataFrame, like: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``like``, in its order, except ``drop``."""
    return df.select(*[c for c in like.columns if c not in drop])


def conform(df: DataFrame, schema: T.StructType | type) -> DataFrame:
    """Columns in the order and the (safely widened) types of a schema or dataclass."""
    return df.to(schema if isinstance(schema, T.StructType) else schema_of(schema))


def format_rows(df: DataFrame, template: str, cols: list[str], out: str = "value") -> DataFrame:
    """One string per row from a template with ``{}`` places."""
    return df.select(fill_template(template, cols).alias(out))


def as_continuous(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mark columns as plain numbers for MLlib, so that an index is not taken for a category."""
    meta = {c: {"ml_attr": {"name": c, "type": "numeric"}} for c in cols}
    return df.withColumns({c: F.col(c).alias(c, metadata=meta[c]) for c in cols})


def drop_constant(train: DataFrame, test: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Drop from both tables the columns with a single value (null is a value) in ``train``.

    Returns the tables and the columns that stayed.
    """
    facts = train.agg(
        F.count("*").alias("n"),
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(f"c{i}")
          for i, c in enumerate(cols)],
    ).first()

    def constant(fact) -> bool:
        return fact["n"] == 0 or (fact["n"] == facts["n"] and fact["lo"] == fact["hi"])

    gone = [c for i, c in enumerate(cols) if constant(facts[f"c{i}"])]
    return train.drop(*gone), test.drop(*gone), [c for c in cols if c not in gone]


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, dfs)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``; nulls are equal.

    Both tables go through one grouping by the whole row. Copies are combined on the map side, so
    a value with many of them is shuffled once per task.
    """
    sides = union_all(
        a.withColumn("__in_b", F.lit(False)), b.select(*a.columns).withColumn("__in_b", F.lit(True))
    )
    found = sides.groupBy(*a.columns).agg(F.max("__in_b").alias("__in_b"))
    return found.filter(~F.col("__in_b")).drop("__in_b")

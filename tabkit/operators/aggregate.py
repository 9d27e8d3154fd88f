"""Grouped and global aggregates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.numeric import int_mean
from tabkit.functions.text import split_fields
from tabkit.operators.joins import lookup_join
from tabkit.operators.order import global_rank
from tabkit.runtime import DEFAULT_LIMITS, materialize, row_bytes

# Columns of a contingency table whose names are not given: as many as a pivot has at most by default.
MAX_COLUMNS = 10_000


def group_sum(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` per composite key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def count_and_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Non-null count and mean of ``value`` per key."""
    return df.groupBy(key).agg(F.count(value).alias("count"), F.avg(value).alias("mean"))


def int_mean_by_key(df: DataFrame, key: str, value: str, out: str = "mean") -> DataFrame:
    """Truncating integer mean per key."""
    return df.groupBy(key).agg(int_mean(value).alias(out))


def min_max(df: DataFrame, col: str) -> DataFrame:
    """Smallest and largest value in one pass."""
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def collect_by_key(df: DataFrame, key: str, value: str, chunk_rows: int) -> DataFrame:
    """The non-null values of every key, sorted, as arrays: ``(key, chunk, values)``.

    Arrays hold at most ``chunk_rows`` values; a key with more gets several rows, numbered from 0
    in value order. The values of such keys are ranked over all tasks first, so that they never
    have to meet in one of them; all other keys are simply grouped.
    """
    pairs = df.select(key, value).filter(F.col(value).isNotNull())
    counts = pairs.groupBy(key).agg(F.count("*").alias("n"))
    large = materialize(counts.filter(F.col("n") > chunk_rows).select(key, F.lit(True).alias("__large")), "large")
    values = F.sort_array(F.collect_list(value)).alias("values")
    chunk_0 = F.lit(0).cast("long").alias("chunk")
    null_key = F.col(key).isNull()
    n_large, size, null_is_large = large.agg(
        F.count("*"), F.sum(row_bytes(large.schema).cast("long")), F.max(null_key)
    ).first()
    if not n_large:
        return pairs.groupBy(key).agg(values).select(key, chunk_0, "values")

    # null is a key like any other here, but does not meet itself in a join
    small = DEFAULT_LIMITS.allow(n_large, size)
    marked = lookup_join(pairs, large.filter(~null_key), key, small=small)
    is_large = F.coalesce(F.col("__large"), null_key & F.lit(null_is_large))
    ranked = global_rank(marked.filter(is_large).select(key, value), [key, value], rank="__rank")
    first = ranked.groupBy(key).agg(F.min("__rank").alias("__first"))
    null_first = first.filter(null_key).first()["__first"] if null_is_large else None
    start = F.coalesce("__first", F.lit(null_first).cast("long"))
    placed = (
        lookup_join(ranked, first.filter(~null_key), key, small=small)
        .withColumn("__at", F.col("__rank") - start)
        .select(key, value, F.expr(f"__at div {chunk_rows}").alias("chunk"))
    )
    whole = marked.filter(~is_large).groupBy(key).agg(values).select(key, chunk_0, "values")
    return placed.groupBy(key, "chunk").agg(values).unionByName(whole)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def pair_counts(df: DataFrame, row: str, col: str, out: str = "n") -> DataFrame:
    """Contingency table as long rows (``row``, ``col``, ``out``): any number of values on either side.

    Both become text and a null shows as "null".
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c)
    return df.select(text(row), text(col)).groupBy(row, col).agg(F.count("*").alias(out))


def crosstab(
    df: DataFrame, row: str, col: str, numeric_order: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """Contingency table: one row per value of ``row``, one column per value of ``col``.

    The columns are ``columns``, or all values; more than `MAX_COLUMNS` of them are an error, take
    `pair_counts` then. The rows come out ordered as text, or by value with ``numeric_order``. A value
    that equals the name of the first column is an error.
    """
    head = f"{row}_{col}"
    counts = pair_counts(df, row, col, "__n").select(F.col(row).alias(head), F.col(col).alias("__col"), "__n")
    if columns is None:
        counts = materialize(counts, "pair-counts")
        names = counts.select("__col").distinct().limit(MAX_COLUMNS + 1).collect()
        if len(names) > MAX_COLUMNS:
            raise ValueError(f"{col} has more than {MAX_COLUMNS} values: name the columns or take pair_counts")
        columns = sorted(r[0] for r in names)
    if head in columns:
        raise ValueError(f"a value of {col} is called {head}, like the column of rows")
    table = counts.groupBy(head).pivot("__col", columns).agg(F.sum("__n")).na.fill(0)
    order = [F.col(head).try_cast("double"), F.col(head)] if numeric_order else [F.col(head)]
    return table.orderBy(*order)


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, nulls and distinct non-null values per column, all columns in one pass."""
    row = df.agg(
        F.count("*").alias("__rows"),
        *[F.count(c).alias(f"{c}__n") for c in cols],
        *[F.count_distinct(c).alias(f"{c}__d") for c in cols],
    )
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("__rows").alias("rows"),
            (F.col("__rows") - F.col(f"{c}__n")).alias("nulls"),
            F.col(f"{c}__d").alias("distincts"),
        )
        for c in cols
    ]
    return row.select(F.inline(F.array(*per_column)))


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value and its count; ties go to the smallest value."""
    return (
        df.groupBy(col)
        .agg(F.count(col).alias("count"))
        .orderBy(F.desc("count"), F.col(col).asc_nulls_last())
        .limit(1)
    )


def most_frequent(
    df: DataFrame, cols: list[str], k: int = 1, out: str = "count", tracked: int = 1024, buckets: int = 8192
) -> DataFrame:
    """The ``k`` most frequent values of ``cols`` with their counts, exact, without shuffling all values.

    A frequent-items sketch over the values' hashes names ``tracked`` candidates. A second pass counts them
    exactly and all other rows by hash bucket only, so ``tracked + buckets`` rows are shuffled per task. No
    value is more frequent than its bucket: only in buckets that reach the k-th candidate's count are the
    values grouped one by one. With skewed values there are few or none; with many evenly spread
    ones nearly all buckets stay open, and the plain grouping is cheaper. The sketch decides the cost, never the result.

    Rows with a null in ``cols`` do not count; without other rows the result is empty. Ties go to the
    smallest values.
    """
    known = reduce(and_, (F.col(c).isNotNull() for c in cols))
    rows = df.select(*cols).filter(known).withColumn("__hash", F.xxhash64(*cols))
    sketch = rows.agg(F.expr(f"approx_top_k(__hash, {tracked}, {4 * tracked})").alias("top")).first()["top"]
    candidate = F.col("__hash").isin([item["item"] for item in sketch or []])
    bucket = F.pmod("__hash", F.lit(buckets))
    counts = (
        rows.select(
            *(F.when(candidate, F.col(c)).alias(c) for c in cols), F.when(~candidate, bucket).alias("__bucket")
        )
        .groupBy(*cols, "__bucket")
        .agg(F.count("*").alias(out))
    )
    counts = materialize(counts, "candidates")
    order = [F.desc(out), *(F.col(c) for c in cols)]
    exact = counts.filter(F.col("__bucket").isNull()).select(*cols, out)
    n, least = exact.orderBy(*order).limit(k).agg(F.count("*"), F.min(out)).first()
    others = counts.filter(F.col("__bucket").isNotNull() & (F.col(out) >= (least if n == k else 0)))
    still_open = [r[0] for r in others.select("__bucket").collect()]  # at most `buckets` numbers
    if still_open:
        rest = rows.filter(~candidate & bucket.isin(still_open))
        exact = exact.unionByName(rest.groupBy(*cols).agg(F.count("*").alias(out)))
    return exact.orderBy(*order).limit(k)


def word_counts(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """How often every word occurs."""
    words = df.select(F.explode(split_fields(F.col(text), sep)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count"))

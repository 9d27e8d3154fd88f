"""Operators fitted on categorical columns.

They all start from `CategoryStats`: the counts and label sums of every value of every column,
gathered in one pass and kept as one written table. Nothing about the values is collected except
one row per column (its mode, its vocabulary size).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.operators.joins import heavy_keys, lookup_join, task_count
from tabkit.operators.order import global_rank
from tabkit.runtime import DEFAULT_LIMITS, Limits, materialize, row_bytes

MISSING = "missing"


@dataclass
class CategoryStats:
    """``table``: (column, value, n, label_n, label_sum), with a null value as a group."""

    cols: list[str]
    table: DataFrame
    vocabulary: dict[str, int]  # distinct non-null values per column
    small: dict[str, bool]  # whether a column's part of the table may be broadcast

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        cols: list[str],
        label: str | None = None,
        limits: Limits = DEFAULT_LIMITS,
        missing: str | None = None,
    ) -> CategoryStats:
        """``missing`` names the category that a null of any type counts as; without it nulls have a group."""
        target = F.lit(None) if label is None else F.col(label)
        text = lambda c: F.col(c).cast("string")
        named = text if missing is None else lambda c: F.coalesce(text(c), F.lit(missing))
        pairs = train.select(
            *[named(c).alias(c) for c in cols], target.cast("double").alias("__label")
        ).unpivot("__label", cols, "column", "value")
        counted = pairs.groupBy("column", "value").agg(
            F.count("*").alias("n"),
            F.count("__label").alias("label_n"),
            F.sum("__label").alias("label_sum"),
        )
        # sorted, so that a reader of one column skips the row groups of the others
        table = materialize(counted.sortWithinPartitions("column"), "categories")
        facts = {
            r["column"]: r
            for r in table.groupBy("column")
            .agg(
                F.count("value").alias("values"),
                F.count("*").alias("rows"),
                F.sum(row_bytes(table.schema).cast("long")).alias("bytes"),
            )
            .collect()
        }
        sizes = {c: (facts[c]["rows"], facts[c]["bytes"]) if c in facts else (0, 0) for c in cols}
        vocabulary = {c: facts[c]["values"] if c in facts else 0 for c in cols}
        return cls(cols, table, vocabulary, _fit_together(sizes, limits))

    def of(self, col: str) -> DataFrame:
        return self.table.filter(F.col("column") == col).drop("column")

    def mode_table(self) -> DataFrame:
        """(column, mode, n): the most frequent non-null value, the smallest one among ties."""
        order = F.struct(-F.col("n"), F.col("value"))
        return (
            self.table.filter(F.col("value").isNotNull())
            .groupBy("column")
            .agg(F.min_by("value", order).alias("mode"), F.max("n").alias("n"))
        )

    def modes(self) -> dict[str, str]:
        return {r["column"]: r["mode"] for r in self.mode_table().collect()}

    @cached_property
    def prior(self) -> float | None:
        """Mean label of the training table."""
        mean = F.try_divide(F.sum("label_sum"), F.sum("label_n"))
        return self.of(self.cols[0]).agg(mean).first()[0]

    @cached_property
    def indexed(self) -> DataFrame:
        """The non-null values with their ``index``: from 0 by descending frequency, then by value."""
        known = self.table.filter(F.col("value").isNotNull())
        if all(self.small.values()):
            order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
            placed = known.withColumn("index", (F.row_number().over(order) - 1).cast("double"))
        else:
            ranked = global_rank(known, ["column", ("n", "desc")], unique=["value"], rank="at")
            first = ranked.groupBy("column").agg(F.min("at").alias("first"))  # one row per column
            index = (F.col("at") - F.col("first")).cast("double")
            placed = ranked.join(F.broadcast(first), "column").withColumn("index", index)
        return materialize(placed.sortWithinPartitions("column"), "indexes")

    def codes(self, index: bool = False, mean: bool = False) -> DataFrame:
        """(column, value) with the asked-for code of every non-null value.

        ``mean`` is the mean label drawn towards the overall mean: with ``n`` labels the latter
        weighs 1 / (1 + exp(n - 1)).
        """
        known = self.indexed if index else self.table.filter(F.col("value").isNotNull())
        if mean:
            weight = 1 / (1 + F.exp(F.col("label_n") - 1))
            posterior = F.try_divide(F.col("label_sum"), F.col("label_n"))
            known = known.withColumn("mean", weight * F.lit(self.prior) + (1 - weight) * posterior)
        return known


def _fit_together(sizes: dict[str, tuple[int, int]], limits: Limits) -> dict[str, bool]:
    """Which columns may be broadcast: each within the limits, and all of them within four times."""
    small, spent = {}, 0
    for col, (rows, size) in sorted(sizes.items(), key=lambda item: item[1][1]):
        small[col] = limits.allow(rows, size) and spent + size <= 4 * limits.bytes
        spent += size if small[col] else 0
    return small


def look_up(df: DataFrame, stats: CategoryStats, codes: DataFrame, extras: list[str]) -> DataFrame:
    """Left join the ``extras`` of every value of every column, as ``__<extra>_<column number>``.

    A null is looked up as "missing". Columns with a small vocabulary do not shuffle ``df``. All others share one
    lookup: their values go out as (row, column, value), meet the codes in one join that spreads hot values, and
    come back as one row of codes per row. So ``df`` itself moves once, whatever the number of columns.
    """
    keys = {c: f"__key_{i}" for i, c in enumerate(stats.cols)}
    df = df.withColumns({key: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c, key in keys.items()})
    for i, (c, key) in enumerate(keys.items()):
        if stats.small[c]:
            found = codes.filter(F.col("column") == c).select(
                F.col("value").alias(key), *[F.col(e).alias(f"__{e}_{i}") for e in extras]
            )
            df = lookup_join(df, found, key, small=True)
    large = [c for c in stats.cols if not stats.small[c]]
    return _look_up_large(df, {c: keys[c] for c in large}, stats, codes, extras) if large else df


def _look_up_large(
    df: DataFrame, keys: dict[str, str], stats: CategoryStats, codes: DataFrame, extras: list[str]
) -> DataFrame:
    """The lookups of all columns of ``keys`` in one join of (row, column, value) with their codes."""
    df = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "lookup-rows")
    at = ["__column", "__value"]
    name = F.create_map(*[F.lit(x) for c, key in keys.items() for x in (c, key)])
    found = codes.filter(F.col("column").isin(*keys)).select(
        name[F.col("column")].alias("__column"), F.col("value").alias("__value"), *extras
    )
    pairs = df.select("__row", *keys.values()).unpivot("__row", list(keys.values()), *at)
    parts = task_count(df, df.count() * len(keys))
    coded = lookup_join(pairs, found, at, small=False, hot=heavy_keys(pairs, at, partitions=parts), row="__row")
    numbers = {key: stats.cols.index(c) for c, key in keys.items()}
    by_row = coded.repartition(parts, "__row").groupBy("__row").agg(
        *[F.max(F.when(F.col("__column") == key, F.col(e))).alias(f"__{e}_{i}") for key, i in numbers.items() for e in extras]
    )
    return df.repartition(parts, "__row").join(by_row, "__row", "left").drop("__row")


def encode(df: DataFrame, *encoders: TargetMeanEncoder | FrequencyIndexer) -> DataFrame:
    """Apply encoders fitted on the same statistics, with one lookup per column for all of them."""
    stats = encoders[0].stats
    if any(e.stats is not stats for e in encoders):
        raise ValueError("the encoders were fitted on different statistics")
    wanted = sorted({e.code for e in encoders})
    coded = look_up(df, stats, stats.codes(**dict.fromkeys(wanted, True)), wanted)
    outputs = [e.output(c, F.col(f"__{e.code}_{i}")) for e in encoders for i, c in enumerate(stats.cols)]
    return coded.select(*df.columns, *outputs)


class ModeImputer:
    """Fill nulls, and on request values unseen in training, with the training mode.

    In training a null counts as the category "missing", so that can be the mode.
    """

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, train: DataFrame) -> ModeImputer:
        self.stats = CategoryStats.fit(train, self.cols, missing=MISSING)
        self.modes = self.stats.modes()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        fills = {c: F.coalesce(F.col(c), _typed(df, c, self.modes.get(c))) for c in self.cols}
        return df.withColumns(fills)

    def replace_unseen(self, df: DataFrame) -> DataFrame:
        return replace_unseen(df, self.stats, self.modes)


def _typed(df: DataFrame, col: str, value: str | None) -> Column:
    """A mode in the type of its column; null where it is no value of that type."""
    return F.lit(value).try_cast(df.schema[col].dataType)


def replace_unseen(df: DataFrame, stats: CategoryStats, modes: dict[str, str]) -> DataFrame:
    """Replace the values that training has not seen with the mode; nulls stay."""
    marked = look_up(df, stats, stats.table.withColumn("seen", F.lit(True)), ["seen"])
    known = {
        c: F.when(F.col(c).isNotNull() & F.col(f"__seen_{i}").isNull(), _typed(df, c, modes.get(c))).otherwise(F.col(c))
        for i, c in enumerate(stats.cols)
    }
    return marked.select(*[known[c].alias(c) if c in known else F.col(c) for c in df.columns])


class TargetMeanEncoder:
    """Replace a category by its mean label, drawn towards the overall mean when it is rare.

    A null is the category "missing"; one without labels in training gets the overall mean.
    """

    code = "mean"

    def __init__(self, cols: list[str], label: str, suffix: str = "_target"):
        self.cols = cols
        self.label = label
        self.suffix = suffix

    def fit(self, train: DataFrame) -> TargetMeanEncoder:
        return self.from_stats(CategoryStats.fit(train, self.cols, self.label, missing=MISSING))

    def from_stats(self, stats: CategoryStats) -> TargetMeanEncoder:
        self.stats = stats
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return encode(df, self)

    def output(self, col: str, found: Column) -> Column:
        return F.coalesce(found, F.lit(self.stats.prior)).alias(col + self.suffix)


class FrequencyIndexer:
    """Index categories by descending training frequency, ties alphabetically.

    A null or unseen category raises under ``invalid="error"`` and gets one extra index, the
    vocabulary size, under ``invalid="keep"``.
    """

    code = "index"

    def __init__(self, cols: list[str], invalid: str = "error", suffix: str = "_index"):
        if invalid not in ("error", "keep"):
            raise ValueError(f"invalid {invalid!r}")
        self.cols = cols
        self.invalid = invalid
        self.suffix = suffix

    def fit(self, train: DataFrame) -> FrequencyIndexer:
        return self.from_stats(CategoryStats.fit(train, self.cols))

    def from_stats(self, stats: CategoryStats) -> FrequencyIndexer:
        self.stats = stats
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return encode(df, self)

    def output(self, col: str, found: Column) -> Column:
        size = self.stats.vocabulary[col]
        if self.invalid == "keep":
            other, slots = F.lit(float(size)), size + 1
        else:
            text = F.coalesce(F.col(col).cast("string"), F.lit("null"))
            other, slots = F.raise_error(F.concat(F.lit(f"unseen {col}: "), text)).cast("double"), size
        meta = {"ml_attr": {"name": col + self.suffix, "type": "nominal", "num_vals": slots}}
        known = F.col(col).isNotNull() & found.isNotNull()
        return F.when(known, found).otherwise(other).alias(col + self.suffix, metadata=meta)

"""Sorting, top-k and consecutive ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.runtime import materialize

# monotonically_increasing_id() holds the partition number above this bit, the row number below.
_ROW_BITS = 33
# Copies of one row that a single task may expand.
_COPIES_PER_TASK = 100_000
# Rows that one task merges for a top-k: k from each partition.
_ROWS_IN_ONE_TASK = 1_000_000

SortKey = str | tuple[str, str]


def sort_columns(by: list[SortKey]) -> list[Column]:
    """``"col"`` or ``("col", "asc" | "desc")`` to ordering columns."""
    out = []
    for key in by:
        name, direction = (key, "asc") if isinstance(key, str) else key
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction {direction!r}")
        out.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return out


def sort_by(df: DataFrame, by: list[SortKey]) -> DataFrame:
    """Total order on several keys, each with its own direction."""
    return df.orderBy(*sort_columns(by))


def top_k(
    df: DataFrame, by: list[SortKey], k: int, unique: list[SortKey] | None = None, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of the order with their 1-based rank.

    Ties go by ``unique``, columns that tell any two rows apart, or else by all the other columns, so that
    the result does not depend on the plan. A small ``k`` is merged from the heads of all partitions; one
    whose heads are too many for a task is cut from the rank of all rows.
    """
    named = {key if isinstance(key, str) else key[0] for key in by}
    full = by + (unique if unique is not None else [c for c in df.columns if c not in named])
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if k * partitions > _ROWS_IN_ONE_TASK:
        return global_rank(df, by, unique, rank=rank).filter(F.col(rank) <= k)
    head = df.orderBy(*sort_columns(full)).limit(k)
    return head.withColumn(rank, F.row_number().over(Window.orderBy(*sort_columns(full))).cast("long"))


def global_rank(
    df: DataFrame, by: list[SortKey], unique: list[SortKey] | None = None, rank: str = "rank"
) -> DataFrame:
    """Number all rows 1..n in the order ``by``.

    ``unique`` names columns that, after ``by``, tell any two rows apart, such as an id. Without it
    ties are ordered by all the other columns, and exact copies of a row are counted first and
    expanded after the sort, so that a row with very many copies is spread over tasks.

    The rows are range-partitioned, sorted within partitions and written once with their position;
    ranks are then the position plus the rows of the partitions before. The single-task window
    runs over one row per partition only.
    """
    columns = df.columns
    if unique is not None:
        order = sort_columns(by + unique)
        placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        named = {k if isinstance(k, str) else k[0] for k in by}
        per_task = F.lit(_COPIES_PER_TASK)
        counted = df.groupBy(*columns).agg(F.count("*").alias("__n"))
        chunked = counted.withColumn(
            "__chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {_COPIES_PER_TASK}")))
        ).withColumn("__n", F.least(per_task, F.col("__n") - F.col("__chunk") * per_task))
        order = sort_columns(by + [c for c in columns if c not in named] + ["__chunk"])
        placed = (
            chunked.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy"))
            .select(*columns)
        )
    placed = materialize(placed.withColumn("__at", F.monotonically_increasing_id()), "ranked")

    part = F.shiftright("__at", _ROW_BITS).alias("__part")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    inside = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")  # one row per shuffle partition
        .select(*columns, (F.col("__offset") + inside + 1).alias(rank))
    )


def zip_by_position(
    left: DataFrame,
    left_by: list[SortKey],
    right: DataFrame,
    right_by: list[SortKey],
    position: str = "position",
) -> DataFrame:
    """Put the n-th row of one ordered table next to the n-th row of the other.

    The tables must have the same number of rows and no column in common.
    """
    a = global_rank(left, left_by, rank=position)
    b = global_rank(right, right_by, rank=position)
    n_left, n_right = a.count(), b.count()
    if n_left != n_right:
        raise ValueError(f"{n_left} rows against {n_right}")
    return a.join(b, position)

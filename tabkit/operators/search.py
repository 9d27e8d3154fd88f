"""Cross-validated search over leaf-wise trees that share their bins and their passes.

Features are binned once for all fits, and rows with equal bins and fold are grouped with their number, label sum
and label square sum. The histograms of a training part are those of all rows less those of the fold held out, so
every first root comes from one grouping. From then on all fits grow side by side: one pass reads the parts that
any of them wants next. Points that differ in the number of trees only are one fit, scored on the way.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.operators.leafwise import Growth, Node, _binned, _cells, _edges, _histograms, _walk
from tabkit.operators.learn import zip_columns
from tabkit.runtime import materialize

# As in `fit_leafwise`.
DEFAULTS = {"trees": 100, "leaves": 31, "rate": 0.1, "leaf_rows": 20, "penalty": 0.0}
# Parts of one fit are numbered below this.
_PARTS = 1 << 24


@dataclass
class _Fit:
    fold: int
    settings: dict
    base: float
    cells: np.ndarray
    stops: set[int] = field(default_factory=set)
    done: bool = False


def points(values: dict[str, list]) -> list[dict]:
    """All combinations of the given values, the last name changing fastest."""
    unknown = set(values) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    return [DEFAULTS | dict(zip(values, point)) for point in product(*values.values())]


def _inside(node: Node) -> Column:
    return F.col("bins")[node.feature] <= node.bin


def _read(rows: DataFrame, wanted: list[tuple[int, int, Column]], shape: tuple[int, int]) -> dict[int, dict[int, np.ndarray]]:
    """Histograms per fit and part, for (place of the fit, fold held out, part) of each fit, in one pass."""
    parts = [
        F.struct(
            F.when(F.col("fold") != fold, part.cast("long") + at * _PARTS).alias("code"),
            (F.col("s") - F.col("n") * F.col("p")[at]).alias("g"),
        )
        for at, fold, part in wanted
    ]
    each = rows.select("n", "bins", F.inline(F.filter(F.array(*parts), lambda x: x["code"].isNotNull())))
    out: dict[int, dict[int, np.ndarray]] = {at: {} for at, _, _ in wanted}
    for code, cells in _histograms(each, F.col("code"), F.col("g"), shape).items():
        at, part = divmod(code, _PARTS)
        out[at][part] = cells
    return out


def cross_validate_leafwise(
    train: DataFrame,
    values: dict[str, list],
    features: str | list[str] = "features",
    label: str = "label",
    folds: int = 3,
    fold_col: str | None = None,
    max_bins: int = 128,
) -> DataFrame:
    """Mean held-out RMSE of every point of a grid over the settings of `fit_leafwise`.

    Returns ``trees``, ``leaves``, ``rate``, ``leaf_rows``, ``penalty``, ``rmse`` and ``is_best`` (the first point
    of those with the least RMSE) in grid order. ``fold_col`` holds folds from 0 to ``folds`` - 1; rows with any
    other fold are left out. Without it the hash of features and label decides, so that copies of a row share
    a fold. Bins are quantiles over all rows; labels never decide them. Rows without a label are left out, missing
    features are a value apart. A fold without rows, or without others to learn from, does not count; if none counts,
    RMSE is null.
    """
    grid = points(values)
    if folds < 2 or max_bins < 2 or any(g["leaves"] < 1 or g["trees"] < 0 for g in grid):
        raise ValueError("two folds, two bins and a leaf are the least")
    fold = F.col(fold_col).cast("int") if fold_col else F.pmod(F.xxhash64(_cells(train, features), F.col(label)), F.lit(folds)).cast("int")
    wide = train.filter(F.col(label).isNotNull()).select(
        _cells(train, features).alias("x"), F.col(label).cast("double").alias("y"), fold.alias("fold")
    )
    wide = wide.filter(F.col("fold").between(0, folds - 1))
    first = wide.select(F.size("x")).first()
    if not first:
        return _report(train, grid, [{} for _ in grid])
    names = [f"__x_{i}" for i in range(first[0])]
    wide = materialize(wide.select(*(F.col("x")[i].alias(n) for i, n in enumerate(names)), "y", "fold"), "search-values")
    edges = _edges(wide, names, max_bins)
    shape = (len(names), max(map(len, edges)) + 2)
    grouped = _binned(wide, names, edges, "fold").groupBy("fold", "bins")
    square = F.sum(F.col("y") * F.col("y")).alias("ss")
    rows = materialize(grouped.agg(F.count("*").alias("n"), F.sum("y").alias("s"), square), "search-bins")

    held = _histograms(rows, F.col("fold"), F.col("s"), shape)
    whole = sum(held.values())
    fits: dict[tuple, _Fit] = {}
    for f, cells in sorted(held.items()):
        n, total = (whole - cells)[0].sum(axis=0)
        if not n:
            continue
        base = float(total / n)
        start = whole - cells
        start[..., 1] -= base * start[..., 0]
        for settings in grid:
            fit = fits.setdefault((f, *_shared(settings)), _Fit(f, settings, base, start))
            fit.stops.add(settings["trees"])
    scores: dict[tuple, float] = {}
    all_fits = list(fits.items())
    if not all_fits:
        return _report(train, grid, [{} for _ in grid])
    rows = rows.withColumn("p", F.array(*(F.lit(fit.base) for _, fit in all_fits)))
    for k in range(max(g["trees"] for g in grid) + 1):
        _score(rows, [(at, key, fit) for at, (key, fit) in enumerate(all_fits) if k in fit.stops], k, scores)
        active = [(at, fit) for at, (_, fit) in enumerate(all_fits) if k < max(fit.stops) and not fit.done]
        if not active:
            continue
        if k:
            found = _read(rows, [(at, fit.fold, F.lit(0)) for at, fit in active], shape)
            for at, fit in active:
                fit.cells = found[at][0]
        growing = {
            at: Growth(Node(0, fit.cells), fit.settings["leaves"], fit.settings["leaf_rows"], fit.settings["penalty"])
            for at, fit in active
        }
        while wanted := [(at, all_fits[at][1].fold, g.part(_inside)) for at, g in growing.items() if g.open()]:
            for at, cells in _read(rows, wanted, shape).items():
                growing[at].close(cells)
        after = [F.col("p")[at] for at in range(len(all_fits))]
        for at, fit in active:
            root = growing[at].root
            fit.done = not root.children and root.value == 0
            after[at] = after[at] + _walk(root, _inside, lambda node, r=fit.settings["rate"]: F.lit(float(r * node.value)))
        rows = materialize(rows.withColumn("p", F.array(*after)), "search-bins")
    return _report(train, grid, [{f: scores[f, *_shared(g), g["trees"]] for f in held if (f, *_shared(g)) in fits} for g in grid])


def _shared(settings: dict) -> tuple:
    """What two points must agree in to be one fit."""
    return tuple(v for name, v in settings.items() if name != "trees")


def _score(rows: DataFrame, fits: list[tuple[int, tuple, _Fit]], trees: int, scores: dict[tuple, float]) -> None:
    """The held-out RMSE of these fits, in one pass: squares come from the groups' sums."""
    if not fits:
        return
    error = lambda p: F.col("ss") - 2 * p * F.col("s") + F.col("n") * p * p
    sums = [
        F.sum(F.when(F.col("fold") == fit.fold, error(F.col("p")[at]))) / F.sum(F.when(F.col("fold") == fit.fold, F.col("n")))
        for at, _, fit in fits
    ]
    found = rows.agg(F.array(*sums)).first()[0]
    for (_, key, _), mean in zip(fits, found):
        scores[*key, trees] = float(np.sqrt(max(mean, 0.0)))


def _report(train: DataFrame, grid: list[dict], found: list[dict[int, float]]) -> DataFrame:
    rmse = [float(np.mean(list(f.values()))) if f else None for f in found]
    known = [r for r in rmse if r is not None]
    best = rmse.index(min(known)) if known else -1
    columns = [[int(g["trees"]) for g in grid], [int(g["leaves"]) for g in grid], [float(g["rate"]) for g in grid]]
    columns += [[int(g["leaf_rows"]) for g in grid], [float(g["penalty"]) for g in grid]]
    schema = "trees long, leaves long, rate double, leaf_rows long, penalty double, rmse double, is_best boolean"
    return zip_columns(train.sparkSession, schema, [*columns, rmse, [i == best for i in range(len(grid))]])

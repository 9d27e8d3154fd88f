"""Boosted regression trees grown leaf by leaf on binned features.

Features are binned once; rows with equal bins are grouped and keep their number and the sum of their labels, which
is all that squared error needs. A round is one grouping: residual sums and counts per (leaf, feature, bin).
Of two children only the smaller one is read, the other is what remains of their parent. The leaf with the
largest gain is split first, until a tree has its leaves. Splits of one leaf do not depend on
those of another, so every round reads the children of all leaves that may still be split, and
a tree takes about as many rounds as it is deep.

What reaches the driver is counts per leaf, feature and bin, whatever the number of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.operators.learn import zip_columns
from tabkit.runtime import materialize

# The predictions are written after this many trees, so that no expression spans more of them.
WRITE_EVERY = 4
_LEAST_GAIN = 1e-9


@dataclass
class Node:
    """A part of the rows with its histogram: ``cells[feature, bin]`` are (rows, residual sum)."""

    number: int
    cells: np.ndarray
    value: float = 0.0
    gain: float = 0.0
    feature: int = -1
    bin: int = -1  # bins up to this one go left
    known: tuple[Node, Node] | None = None  # the parts it would be split into
    children: tuple[Node, Node] | None = None  # those it is split into

    def choose(self, leaf_rows: int, penalty: float) -> None:
        """The split with the largest gain; ties go to the first feature and the lowest bin."""
        total = self.cells[0].sum(axis=0)
        score = lambda x: x[..., 1] ** 2 / np.maximum(x[..., 0] + penalty, 1e-300)
        self.value = float(total[1] / (total[0] + penalty)) if total[0] else 0.0
        left = np.cumsum(self.cells, axis=1)[:, :-1]
        if not left.size:
            return
        right = total - left
        gain = score(left) + score(right) - score(total)
        gain[(left[..., 0] < leaf_rows) | (right[..., 0] < leaf_rows)] = 0
        at = int(np.argmax(gain))
        self.gain = float(gain.flat[at])
        if self.gain <= _LEAST_GAIN * (1 + float(score(total))):
            self.gain = 0.0
        self.feature, self.bin = divmod(at, gain.shape[1])

    def leaves(self) -> Iterator[Node]:
        for child in self.children or ():
            yield from child.leaves()
        if not self.children:
            yield self


def _walk(node: Node, test, end) -> Column:
    """The tree as a nested condition: ``test`` of a split node, ``end`` of a leaf."""
    if not node.children:
        return end(node)
    left, right = node.children
    return F.when(test(node), _walk(left, test, end)).otherwise(_walk(right, test, end))


@dataclass
class LeafwiseModel:
    """Fitted trees. ``edges[i]`` separate the bins of feature i; missing values have one more, the last."""

    features: str | list[str]
    edges: list[list[float]]
    base: float
    rate: float
    trees: list[Node] = field(default_factory=list)
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a prediction for every row."""
        cells = "__cells"

        def test(node: Node) -> Column:
            value, edges = F.col(cells)[node.feature], self.edges[node.feature]
            return value < F.lit(edges[node.bin]) if node.bin < len(edges) else value.isNotNull() & ~F.isnan(value)

        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _walk(tree, test, lambda n: F.lit(self.rate * n.value))
        scored = df.withColumn(cells, _cells(df, self.features)).withColumn(self.prediction, total)
        return scored.drop(cells)

    def importance(self) -> list[float]:
        """Gain of each feature's splits, every tree and then the sum scaled to one."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            gains = np.zeros(len(self.edges))
            for node in _splits(tree):
                gains[node.feature] += node.gain
            total += gains / gains.sum() if gains.sum() else 0
        return (total / total.sum() if total.sum() else total).tolist()


def _splits(node: Node) -> Iterator[Node]:
    if node.children:
        yield node
        for child in node.children:
            yield from _splits(child)


def importance_table(df: DataFrame, model: LeafwiseModel, names: list[str]) -> DataFrame:
    """(feature, importance), most important first."""
    return zip_columns(df.sparkSession, ["feature", "importance"], [names, model.importance()]).orderBy(
        F.desc("importance"), "feature"
    )


def _cells(df: DataFrame, features: str | list[str]) -> Column:
    """The features of a row as an array; a vector column or a list of numeric columns."""
    if isinstance(features, str):
        return vector_to_array(features)
    return F.array(*(F.col(f"`{c}`").cast("double") for c in features))


def _edges(df: DataFrame, names: list[str], max_bins: int) -> list[list[float]]:
    """Approximate quantiles of every column, in one pass, as the lower ends of its bins but the first."""
    at = [i / max_bins for i in range(max_bins + 1)]
    found = df.approxQuantile(names, at, 0.1 / max_bins)
    return [sorted({float(x) for x in q if np.isfinite(x)})[1:] for q in found]


def _binned(df: DataFrame, names: list[str], edges: list[list[float]], *keep: str) -> DataFrame:
    """The bin of every feature: how many edges are not above its value. Missing values have the next bin after those."""
    bins = [f"__bin_{i}" for i in range(len(names))]
    missing = df.withColumns({n: F.coalesce(n, F.lit(float("nan"))) for n in names})
    bucket = Bucketizer(
        splitsArray=[[-np.inf, *e, np.inf] if e else [-np.inf, 0.0, np.inf] for e in edges],
        inputCols=names,
        outputCols=bins,
        handleInvalid="keep",
    ).transform(missing)
    return bucket.select(
        F.array(*(F.col(b).cast("int") if e else F.floor(F.col(b) / 2).cast("int") for b, e in zip(bins, edges))).alias("bins"),
        "y",
        *keep,
    )


def _histograms(rows: DataFrame, leaf: Column, residual: Column, shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """Rows and residual sums per (leaf, feature, bin), in one grouping."""
    cells = (
        rows.select(leaf.alias("leaf"), F.col("n"), residual.alias("g"), "bins")
        .filter("leaf IS NOT NULL")
        .select("leaf", "n", "g", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("leaf", "feature", "bin")
        .agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
        .toArrow()
    )
    at = [cells.column(c).to_numpy() for c in ("leaf", "feature", "bin")]
    out = {}
    for number in np.unique(at[0]).tolist():
        here = at[0] == number
        grid = np.zeros((*shape, 2))
        for k, c in enumerate(("n", "g")):
            grid[at[1][here], at[2][here], k] = cells.column(c).to_numpy()[here]
        out[number] = grid
    return out


def _grow(root: Node, leaves: int) -> list[Node]:
    """Split the leaf with the largest gain until there are enough. Returns those whose parts must be read first."""
    waiting = [(-root.gain, root.number, root)]
    root.children, count, unknown = None, 1, []
    while waiting and count < leaves:
        _, _, node = heapq.heappop(waiting)
        if node.gain <= 0:
            break
        if not node.known:
            unknown.append(node)
        else:
            node.children = node.known
            for child in node.children:
                child.children = None
                heapq.heappush(waiting, (-child.gain, child.number, child))
        count += 1
    return unknown


def fit_leafwise(
    train: DataFrame,
    features: str | list[str] = "features",
    label: str = "label",
    trees: int = 100,
    leaves: int = 31,
    rate: float = 0.1,
    max_bins: int = 128,
    leaf_rows: int = 20,
    penalty: float = 0.0,
) -> LeafwiseModel:
    """Fit boosted trees by squared error, each with up to ``leaves`` leaves of ``leaf_rows`` rows or more.

    ``features`` is a vector column or a list of numeric columns. A missing feature (null or NaN) is a value
    apart that counts as the largest; rows without a label are left out. ``penalty`` is added to the rows of a leaf in its value
    and gain. Ties go to the first feature, the lowest bin and the leaf made first, so that the same table gives the
    same trees. A table without labels predicts zero.
    """
    if leaves < 1 or max_bins < 2:
        raise ValueError("a tree has a leaf and a feature two bins")
    wide = train.filter(F.col(label).isNotNull()).select(_cells(train, features).alias("x"), F.col(label).cast("double").alias("y"))
    first = wide.select(F.size("x")).first()
    width = first[0] if first else 0
    names = [f"__x_{i}" for i in range(width)]
    if not width:
        return LeafwiseModel(features, [], _mean(wide), rate)
    wide = materialize(wide.select(*(F.col("x")[i].alias(n) for i, n in enumerate(names)), "y"), "leafwise-values")
    edges = _edges(wide, names, max_bins)
    grouped = _binned(wide, names, edges).groupBy("bins").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    rows = materialize(grouped, "leafwise-bins")
    total = rows.agg(F.sum("s"), F.sum("n")).first()
    model = LeafwiseModel(features, edges, float(total[0] / total[1]), rate)
    shape = (width, max(map(len, edges)) + 2)
    rows = rows.withColumn("p", F.lit(model.base))
    inside = lambda n: F.col("bins")[n.feature] <= n.bin
    for k in range(trees):
        residual = F.col("s") - F.col("n") * F.col("p")
        tree = _fit_tree(rows, residual, inside, shape, leaves, leaf_rows, penalty)
        model.trees.append(tree)
        if not tree.children and tree.value == 0:
            break
        rows = rows.withColumn("p", F.col("p") + _walk(tree, inside, lambda n: F.lit(rate * n.value)))
        if k % WRITE_EVERY == WRITE_EVERY - 1:
            rows = materialize(rows, "leafwise-bins")
    return model


def _mean(wide: DataFrame) -> float:
    return wide.agg(F.avg("y")).first()[0] or 0.0


def _fit_tree(rows: DataFrame, residual: Column, inside, shape: tuple[int, int], leaves: int, leaf_rows: int, penalty: float) -> Node:
    growing = Growth(Node(0, _histograms(rows, F.lit(0), residual, shape)[0]), leaves, leaf_rows, penalty)
    while growing.open():
        growing.close(_histograms(rows, growing.part(inside), residual, shape))
    return growing.root


class Growth:
    """A tree on its way: which parts of the rows are to be read next, and what follows from them."""

    def __init__(self, root: Node, leaves: int, leaf_rows: int, penalty: float):
        self.root, self.leaves, self.leaf_rows, self.penalty = root, leaves, leaf_rows, penalty
        self.made, self.unknown, self.smaller = 1, [], {}
        root.choose(leaf_rows, penalty)

    def open(self) -> bool:
        """Split as far as the histograms allow. False if the tree is done."""
        self.unknown, self.smaller = _grow(self.root, self.leaves), {}
        for node in self.unknown:
            left = node.cells[node.feature, : node.bin + 1, 0].sum()
            is_left = 2 * left <= node.cells[node.feature, :, 0].sum()
            self.smaller[node.number] = (self.made if is_left else self.made + 1, is_left)
            node.known = tuple(Node(self.made + i, np.empty(0)) for i in (0, 1))
            self.made += 2
        return bool(self.unknown)

    def part(self, inside) -> Column:
        """The number of the part to be read that a row is in, or null."""

        def of(node: Node) -> Column | None:
            if node.number in self.smaller and not node.children:
                number, is_left = self.smaller[node.number]
                return F.when(inside(node) if is_left else ~inside(node), F.lit(number))
            sides = [of(child) for child in node.children or ()]
            if all(side is None for side in sides):
                return None
            left, right = sides
            if right is None:
                return F.when(inside(node), left)
            return F.when(~inside(node), right) if left is None else F.when(inside(node), left).otherwise(right)

        return of(self.root)

    def close(self, found: dict[int, np.ndarray]) -> None:
        """Take the histograms of the parts that were read; those of their siblings are the rest."""
        for node in self.unknown:
            number, is_left = self.smaller[node.number]
            child, other = node.known if is_left else reversed(node.known)
            child.cells = found[number]
            other.cells = node.cells - child.cells
            for part in node.known:
                part.choose(self.leaf_rows, self.penalty)

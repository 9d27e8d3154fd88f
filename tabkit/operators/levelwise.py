"""Cross-validated depths of boosted regression trees, all fits grown side by side.

The trees are those of MLlib's `GBTRegressor`: squared error, the first tree on the labels with weight one, later ones on
twice the residuals with weight ``rate``, every level split wherever there is a gain. MLlib reads the rows once for each level of each tree
of each fit; here one pass reads them for that level of all fits. Features are binned once and kept in blocks of
rows with the predictions of every fit, spread by the number of rows. A task adds up its blocks' histograms, and those of one node meet
by a shuffle. Of two children only the smaller is read, the other is what remains of their parent.

A block has so many bytes, whatever the number of fits; a few make an Arrow batch or a row group. So a task holds
some megabytes of blocks at a time, however many rows it reads.

What reaches the driver is counts per fit, node and bin, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.leafwise import _cells
from tabkit.operators.learn import spread
from tabkit.runtime import delete_folder, let_workers_import, materialize, scratch_path

# Bytes of one block, of an Arrow batch before its last block, and blocks of a row group, which Parquet's reader holds at once.
BLOCK_BYTES, BATCH_BYTES, GROUP_BLOCKS = 1 << 20, 2 << 20, 8
# Rows of one Arrow batch of values, which blocks are made of.
BATCH_ROWS = 10_000
_BLOCKS = "x binary, y binary, fold binary, p binary"
_LEAST_GAIN = 1e-12


def _edges(wide: DataFrame, names: list[str], max_bins: int) -> list[np.ndarray]:
    """The lower ends of every column's bins but the first: all its values, or quantiles where it has more than ``max_bins``."""
    sizes = wide.agg(*(F.approx_count_distinct(n).alias(n) for n in names)).first()
    few = [n for n in names if sizes[n] <= 2 * max_bins]
    values = wide.agg(*(F.collect_set(n).alias(n) for n in few)).first() if few else {}  # a few hundred each
    found = {n: sorted(values[n])[1:] for n in few if len(values[n]) <= max_bins}
    many = [n for n in names if n not in found]
    at = [i / max_bins for i in range(max_bins + 1)]
    for n, q in zip(many, wide.approxQuantile(many, at, 0.1 / max_bins) if many else []):
        found[n] = sorted(set(q))[1:]
    return [np.array([v for v in found[n] if np.isfinite(v)]) for n in names]


class Tree:
    """A tree as arrays: the children of node i are 2 i + 1 and 2 i + 2, a leaf has no feature."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature, self.bin, self.value = np.full(size, -1), np.zeros(size, int), np.zeros(size)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node each row has come to. ``x`` has the bins by feature and row."""
        at, rows = np.zeros(x.shape[1], int), np.arange(x.shape[1])
        for _ in range(self.depth):
            feature = self.feature[at]
            split = feature >= 0
            if not split.any():
                break
            at = np.where(split, 2 * at + 1 + (x[feature, rows] > self.bin[at]), at)
        return at


def _choose(cells: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every node's histogram (node, bin, (rows, sum)): gain, feature, bin, and rows and sum left of the best split."""
    total = cells[:, : starts[1]].sum(axis=1)
    score = lambda c: c[..., 1] ** 2 / np.maximum(c[..., 0], 1)
    best, feature, bin_, left = np.zeros(len(cells)), np.full(len(cells), -1), np.zeros(len(cells), int), np.zeros((len(cells), 2))
    for j, (low, high) in enumerate(zip(starts, starts[1:])):
        below = np.cumsum(cells[:, low : high - 1], axis=1)
        if not below.shape[1]:
            continue
        above = total[:, None] - below
        gain = score(below) + score(above) - score(total)[:, None]
        gain[(below[..., 0] < 1) | (above[..., 0] < 1)] = 0
        at = np.argmax(gain, axis=1)
        here = np.take_along_axis(gain, at[:, None], 1)[:, 0]
        better = here > np.maximum(best, _LEAST_GAIN * (1 + score(total)))
        best[better], feature[better], bin_[better] = here[better], j, at[better]
        left[better] = below[better, at[better]]
    return best, feature, bin_, left


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins by feature and row, labels, folds and predictions by fit and row of every block."""
    for x, y, fold, p in zip(*(c.to_pylist() for c in batch.columns)):
        y = np.frombuffer(y)
        yield np.frombuffer(x, "<u2").reshape(width, -1), y, np.frombuffer(fold, "<i4"), np.frombuffer(p).reshape(-1, len(y))


def _mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(fn, schema)


def block_rows(width: int, fits: int) -> int:
    """Rows of one block: bins, label, fold and the predictions of every fit take `BLOCK_BYTES`."""
    return max(1, BLOCK_BYTES // (2 * width + 12 + 8 * fits))


def _blocks(wide: DataFrame, edges: list[np.ndarray], fits: int) -> DataFrame:
    """Rows (x array, y, fold) as blocks of binned rows, predictions zero."""
    most = block_rows(len(edges), fits)

    def block(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bins, y, fold = (np.concatenate(c, axis=-1) for c in zip(*parts))
        cells = [bins, y, fold, np.zeros((fits, len(y)))]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["x", "y", "fold", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, most - held)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(edges))
                bins = [np.where(np.isnan(v), len(e) + 1, np.searchsorted(e, v, "right")) for e, v in zip(edges, x.T)]
                parts.append((np.array(bins, "<u2"), part.column(1).to_numpy(), part.column(2).to_numpy()))
                at, held = at + part.num_rows, held + part.num_rows
                if held == most:
                    yield block(parts)
                    parts, held = [], 0
        if parts:
            yield block(parts)

    return _mapped(wide, run, _BLOCKS)


def _written(rows: DataFrame) -> tuple[DataFrame, str]:
    """The blocks, written, and their folder: only the newest ones are kept."""
    path = scratch_path(rows.sparkSession, "levelwise-blocks")
    rows.write.option("parquet.block.row.count.limit", GROUP_BLOCKS).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _moved(rows: DataFrame, trees: list[Tree], weight: float, width: int) -> DataFrame:
    """The blocks with one more tree in every fit's predictions."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = [
                (p + weight * np.array([t.value[t.nodes(x)] for t in shared.value])).tobytes() for x, _, _, p in _unpacked(batch, width)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(after, pa.binary())], names=["x", "y", "fold", "p"])

    return _mapped(rows, run, _BLOCKS)


def _histograms(
    rows: DataFrame, trees: list[Tree], held: list[int], wanted: list[np.ndarray], starts: np.ndarray, first: bool
) -> dict[tuple[int, int], np.ndarray]:
    """(rows, sum) per bin of the ``wanted`` nodes of every fit, in one pass over all training parts."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, held, wanted))
    width, total = len(starts) - 1, int(starts[-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, held, wanted = shared.value
        sums = [np.zeros((len(w), total, 2)) for w in wanted]
        for batch in batches:
            for x, y, fold, p in _unpacked(batch, width):
                placed = x + starts[:-1, None]
                for k, (tree, fold_out, nodes) in enumerate(zip(trees, held, wanted)):
                    if not len(nodes):
                        continue
                    place = np.full(len(tree.feature), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[tree.nodes(x)]
                    use = np.flatnonzero((at >= 0) & (fold != fold_out))
                    code = (placed[:, use] + at[use] * total).ravel()
                    g = np.tile(y[use] if first else 2 * (y[use] - p[k, use]), width)
                    size = len(nodes) * total
                    sums[k][..., 0] += np.bincount(code, minlength=size).reshape(-1, total)
                    sums[k][..., 1] += np.bincount(code, g, size).reshape(-1, total)
        found = [(k, int(n), s[i].tobytes()) for k, (nodes, s) in enumerate(zip(wanted, sums)) for i, n in enumerate(nodes)]
        task = TaskContext.get().partitionId()
        cells = list(zip(*found)) or [()] * 3
        kinds = (pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(cells, kinds)), pa.array([task] * len(found), pa.int32())], names=["fit", "node", "cells", "task"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for fit, node, cells in zip(*(batch.column(i).to_pylist() for i in range(3))):
                here = np.frombuffer(cells)
                sums[fit, node] = sums[fit, node] + here if (fit, node) in sums else here
        columns = [pa.array([f for f, _ in sums], pa.int32()), pa.array([n for _, n in sums], pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fit", "node", "cells"])

    parts = _mapped(rows, count, "fit int, node int, cells binary, task int")
    # always added up in the order of the tasks
    parts = parts.repartition("fit", "node").sortWithinPartitions("fit", "node", "task")
    found = _mapped(parts, add, "fit int, node int, cells binary").collect()
    return {(r["fit"], r["node"]): np.frombuffer(r["cells"]).reshape(total, 2) for r in found}


def _grow(rows: DataFrame, depths: list[int], held: list[int], starts: np.ndarray, first: bool) -> list[Tree]:
    """The next tree of every fit, level by level."""
    trees = [Tree(d) for d in depths]
    known: list[dict[int, np.ndarray]] = [{} for _ in trees]  # histograms of the nodes of this level
    wanted = [np.zeros(1, int) for _ in trees]
    siblings: list[dict[int, tuple[int, np.ndarray]]] = [{} for _ in trees]
    for level in range(max(1, *depths)):
        found = _histograms(rows, trees, held, wanted, starts, first) if any(map(len, wanted)) else {}
        for k, tree in enumerate(trees):
            known[k] = {int(n): found[k, int(n)] for n in wanted[k]}
            known[k] |= {other: cells - known[k][n] for n, (other, cells) in siblings[k].items()}
            nodes, wanted[k], siblings[k] = sorted(known[k]), np.zeros(0, int), {}
            if not nodes:
                continue
            cells = np.array([known[k][n] for n in nodes])
            if not level:
                n, total = cells[0, : starts[1]].sum(axis=0)
                tree.value[0] = total / max(n, 1)
            if level >= tree.depth:
                continue
            for node, here, feature, at, left in zip(nodes, cells, *_choose(cells, starts)[1:]):
                if feature < 0:
                    continue
                tree.feature[node], tree.bin[node] = feature, at
                right = here[: starts[1]].sum(axis=0) - left
                for child, (n, total) in ((2 * node + 1, left), (2 * node + 2, right)):
                    tree.value[child] = total / n
                if level + 1 < tree.depth:
                    small, large = (2 * node + 1, 2 * node + 2) if left[0] <= right[0] else (2 * node + 2, 2 * node + 1)
                    wanted[k] = np.append(wanted[k], small)
                    siblings[k][small] = (large, here)
    return trees


def _errors(rows: DataFrame, held: list[int], width: int) -> dict[int, float]:
    """The RMSE of every fit on the fold it has not seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(held), 2))
        for batch in batches:
            for _, y, fold, p in _unpacked(batch, width):
                for k, fold_out in enumerate(held):
                    out = fold == fold_out
                    sums[k] += out.sum(), ((y[out] - p[k, out]) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), *map(pa.array, sums.T)], names=["fit", "n", "se"])

    found = _mapped(rows, run, "fit int, n double, se double").groupBy("fit").agg(F.sum("n").alias("n"), F.sum("se").alias("se")).collect()
    return {r["fit"]: float(np.sqrt(r["se"] / r["n"])) for r in found if r["n"]}


def cross_validate_depths(
    train: DataFrame,
    depths: list[int],
    folds: int = 3,
    trees: int = 20,
    rate: float = 0.1,
    features: str | list[str] = "features",
    label: str = "label",
    fold_col: str | None = None,
    max_bins: int = 128,
) -> list[float | None]:
    """Mean held-out RMSE of boosted trees of each of the ``depths``, as many as ``trees``.

    ``fold_col`` holds folds from 0 to ``folds`` - 1; rows with any other fold are left out. Without it the hash of features
    and label decides, so that copies of a row share a fold. A feature of at most ``max_bins`` values is split between any
    two of them, others at quantiles over all rows; missing ones are largest. Rows without a label are left out. A fold
    without rows, or without others to learn from, does not count; if none counts, the error is None.
    """
    if folds < 2 or max_bins < 2 or max_bins >= 1 << 16 or trees < 1 or min(depths) < 0:
        raise ValueError("two folds, two bins and a tree are the least")
    let_workers_import(train.sparkSession)
    cells = _cells(train, features)
    fold = F.col(fold_col).cast("int") if fold_col else F.pmod(F.xxhash64(cells, F.col(label)), F.lit(folds)).cast("int")
    wide = train.filter(F.col(label).isNotNull()).select(cells.alias("x"), F.col(label).cast("double").alias("y"), fold.alias("fold"))
    wide = materialize(wide.filter(F.col("fold").between(0, folds - 1)), "levelwise-values")
    sizes = {r["fold"]: r["n"] for r in wide.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return [None] * len(depths)
    width = wide.select(F.size("x")).first()[0]
    names = [f"x_{i}" for i in range(width)]
    edges = _edges(wide.select(*(F.col("x")[i].alias(n) for i, n in enumerate(names))), names, max_bins)
    starts = np.concatenate(([0], np.cumsum([len(e) + 2 for e in edges])))
    fits = [(d, f) for d in depths for f in sorted(sizes)]
    tall, held = [d for d, _ in fits], [f for _, f in fits]
    rows, path = _written(_blocks(spread(wide, sum(sizes.values())), edges, len(fits)))
    for k in range(trees):
        grown, before = _grow(rows, tall, held, starts, first=not k), path
        rows, path = _written(_moved(rows, grown, rate if k else 1.0, width))
        delete_folder(train.sparkSession, before)
    errors = _errors(rows, held, width)
    delete_folder(train.sparkSession, path)
    return [float(np.mean([errors[i] for i, (d, _) in enumerate(fits) if d == depth])) for depth in depths]

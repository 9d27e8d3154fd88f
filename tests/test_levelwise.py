import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabkit.operators import learn, levelwise
from tabkit.operators.levelwise import cross_validate_depths


def _rows(spark, n=600):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    rows = spark.range(n).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 40).cast("double").alias("b"), (F.col("id") % 3).cast("int").alias("fold"),
        (noise + F.col("id") % 7 * (F.col("id") % 40 > 11).cast("int") + F.sqrt(F.col("id") % 40)).alias("label"),
    )
    return learn.assemble(rows, ["a", "b"])


def test_depths_score_as_mllibs_trees_do(spark):
    rows = _rows(spark)
    mllib = learn.cross_validate(rows, learn.gbt(maxIter=6), {"maxDepth": [0, 2, 4]}, folds=3, fold_col="fold")
    got = cross_validate_depths(rows, [0, 2, 4], folds=3, trees=6, fold_col="fold")
    assert got == pytest.approx([float(m) for m in mllib.avgMetrics], rel=1e-9)


def test_one_pass_a_level_serves_all_fits(spark):
    """Six fits of two trees: MLlib starts some jobs for every level of each."""
    rows = _rows(spark).cache()
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("levelwise", "")
    cross_validate_depths(rows, [2, 3], folds=3, trees=2, fold_col="fold")
    jobs = len(status.getJobIdsForGroup("levelwise"))
    spark.sparkContext.setJobGroup("mllib", "")
    learn.cross_validate(rows, learn.gbt(maxIter=2), {"maxDepth": [2, 3]}, folds=3, parallelism=1, fold_col="fold")
    theirs = len(status.getJobIdsForGroup("mllib"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 40 and jobs < theirs / 2


def test_few_rows_are_few_partitions(spark):
    assert learn.spread(spark.range(100), 100).rdd.getNumPartitions() == 1
    assert learn.spread(spark.range(100), 10**9).rdd.getNumPartitions() == 8


def test_a_task_holds_a_few_blocks_however_many_rows_it_reads(spark, monkeypatch):
    """One task, fifteen fits: 34 MB of blocks."""
    unpacked, written, groups = levelwise._unpacked, levelwise._written, []

    def few(batch, width):
        assert batch.nbytes < 4 << 20
        return unpacked(batch, width)

    def kept(rows):
        out, path = written(rows)
        for file in out.inputFiles():
            meta = pq.ParquetFile(file.removeprefix("file://")).metadata
            groups.extend(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups))
        return out, path

    monkeypatch.setattr(levelwise, "spread", lambda df, rows: df.coalesce(1))
    monkeypatch.setattr(levelwise, "_unpacked", few)
    monkeypatch.setattr(levelwise, "_written", kept)
    got = cross_validate_depths(_rows(spark, 250_000), [0, 1, 2, 3, 4], folds=3, trees=1, fold_col="fold")
    assert got == sorted(got, reverse=True) and got[0] > got[-1]
    assert len(groups) > 2 and max(groups) < 16 << 20


def test_blocks_keep_every_row_in_order(spark, monkeypatch):
    rows = spark.range(1000, numPartitions=1).select(
        F.array(F.col("id") % 5 * 1.0, F.when(F.col("id") % 3 > 0, F.col("id") * 1.0)).alias("x"), (F.col("id") * 1.0).alias("y"), (F.col("id") % 4).cast("int").alias("fold")
    )
    monkeypatch.setattr(levelwise, "BLOCK_BYTES", 40 * 77)  # 77 rows of 40 bytes
    monkeypatch.setattr(levelwise, "BATCH_ROWS", 100)
    found = levelwise._blocks(rows, [np.array([1.0, 2.0, 3.0, 4.0]), np.array([500.0])], fits=3).collect()
    x, y, fold = np.hstack([np.frombuffer(r["x"], "<u2").reshape(2, -1) for r in found]), *(np.frombuffer(b"".join(r[c] for r in found), t) for c, t in (("y", "<f8"), ("fold", "<i4")))
    ids = np.arange(1000)
    assert [len(r["y"]) // 8 for r in found] == [77] * 12 + [76] and all(r["p"] == bytes(3 * len(r["y"])) for r in found)
    assert (y == ids).all() and (fold == ids % 4).all() and (x[0] == ids % 5).all()
    assert (x[1] == np.where(ids % 3 > 0, ids >= 500, 2)).all()  # missing ones come last


def test_rows_that_do_not_count(spark):
    one = spark.createDataFrame([(1.0, 0, 2.0), (1.0, 0, 3.0)], "a double, fold int, label double")
    assert cross_validate_depths(one, [1], folds=2, features=["a"], fold_col="fold") == [None]
    more = one.unionByName(spark.createDataFrame([(None, 1, 4.0), (2.0, 1, None), (2.0, 9, 100.0)], one.schema))
    # fold 0 is told 4 for 2 and 3, fold 1 their mean for 4
    assert cross_validate_depths(more, [1], folds=2, features=["a"], fold_col="fold") == pytest.approx([(math.sqrt(2.5) + 1.5) / 2])

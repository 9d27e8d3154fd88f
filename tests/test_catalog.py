"""Every registered query against DuckDB on the same tables, and the shape of its plan."""

import contextlib
import io
import os
import re
import shutil
import subprocess
import sys

import pytest
from compare import connect, mismatch

import __spark_entry__ as contract
from tabkit.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    # no Python in the rows' way, no pairing of everything with everything
    assert not re.search(r"EvalPython|InPandas|InArrow|Cartesian|NestedLoop", plan(df))
    assert mismatch(df, con, ORACLES[name]) is None


def test_top_k_does_not_sort_everything(spark):
    text = plan(QUERIES["top_k_ranked"](spark, FOLDER))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_encoding_does_not_shuffle_the_orders(spark):
    text = plan(QUERIES["target_mean_encode"](spark, FOLDER))
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text


def test_scans_read_only_what_is_used(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan(QUERIES["group_sum_composite"](spark, FOLDER)))
    assert [c.split(":")[0] for c in schemas[0].split(",")] == ["o_orderstatus", "o_totalprice", "o_orderpriority"]


@pytest.mark.parametrize("name", ["word_counts", "except_rows", "mode_of_expression", "crosstab_segment"])
def test_groups_are_combined_before_the_shuffle(spark, name):
    lines = plan(QUERIES[name](spark, FOLDER)).splitlines()
    lowest = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "HashAggregate" in lines[lowest + 1]


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_text_classifier_scores_every_document(spark):
    scored = QUERIES["text_classify"](spark, FOLDER)
    assert scored.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert scored.filter("probability < 0 OR probability > 1 OR probability IS NULL").count() == 0


def test_importances_are_sorted_and_add_up(spark):
    values = [r["importance"] for r in QUERIES["feature_importance"](spark, FOLDER).collect()]
    assert values == sorted(values, reverse=True)
    assert abs(sum(values) - 1) < 1e-6


def test_cross_validation_reports_the_grid(spark):
    points = QUERIES["gbt_cv"](spark, FOLDER).collect()
    assert [p["max_depth"] for p in points] == [3, 4, 5]
    best = [p for p in points if p["is_best"]]
    assert len(best) == 1 and best[0]["rmse"] == min(p["rmse"] for p in points)


def test_submission_has_one_row_per_order(spark):
    scored = QUERIES["score_submission"](spark, FOLDER)
    assert scored.columns == ["o_orderkey", "o_totalprice"]
    late = spark.read.parquet(f"{FOLDER}/orders.parquet").filter("o_orderdate >= timestamp_ntz'1998-01-01'").select("o_orderkey")
    assert sorted(scored.select("o_orderkey").collect()) == sorted(late.collect())
    assert scored.filter("o_totalprice <= 0").count() == 0


def test_the_rest_works_without_the_text_operators(tmp_path):
    """A copy without `tabkit/llm` and `tests/llm`, with and without the pipeline's file."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for i, gone in enumerate(([], ["corpus_pipeline.py"])):
        copy = tmp_path / str(i)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", *gone))
        code = "import __spark_entry__ as e; print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))"
        env = {**os.environ, "PYTHONPATH": str(copy)}
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True)
        assert out.stdout.split() == [str(len(QUERIES)), "0"]

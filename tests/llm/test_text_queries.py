"""The registered text queries on the small tables, and the pipeline stage by stage."""

import contextlib
import hashlib
import io
import re

import numpy as np
import pytest
from compare import connect, mismatch
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tabkit.llm.queries import ORACLES, QUERIES, tokenizer_file
from tabkit.runtime import materialize

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert not re.search("Cartesian|NestedLoop", plan(df))
    assert mismatch(df, connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op1_fingerprints", "op5_personal", "op10_urls"])
def test_native_queries_run_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


def test_the_texts_of_op2_are_dealt_once(spark):
    df = QUERIES["op2_repeats"](spark, FOLDER)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_COL") == 2 and final.count("ReusedExchange") == 2


def test_ids_of_all_documents(spark):
    library = Tokenizer.from_file(tokenizer_file())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op9_bpe"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], FOLDER), "stage"))
    calm, single, clean, redacted, tokens = kept[1:]
    assert all(k.columns == columns for k in (calm, single, clean, redacted))
    assert ids(calm) == ids(QUERIES["op4_toxicity"](spark, FOLDER).filter("predicted = 0"))
    assert set(ids(single)) < set(ids(calm)) and single.select("text").distinct().count() == single.count()
    hit = ids(QUERIES["op7_decontaminate"](spark, FOLDER).filter("contaminated"))
    assert ids(clean) == sorted(set(ids(single)) - set(hit)) and set(ids(single)) & set(hit)
    assert ids(redacted) == ids(clean) == ids(tokens)
    found = {r["doc_id"]: r["spans"] for r in QUERIES["op5_personal"](spark, FOLDER).collect()}
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in redacted.collect():
        assert (r["text"] != before[r["doc_id"]]) == bool(found[r["doc_id"]])
        assert r["n_chars"] == len(r["text"]) and not re.search(r"[a-z]\.\d\d@mail", r["text"])


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), "stage")
    assert docs.count() == 0

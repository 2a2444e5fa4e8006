"""Stages of the corpus pipeline on small tables, and the registered queries."""

import os
import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from stmtscope.llm.pieces import MODEL

from test_near_dup import by_all_pairs
from test_quality import junk, prose

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = [(i, prose(rng, 60) + f" mail me{i}@site.example.org", "en", f"s{i % 3 and 1}", 1, "own") for i in range(80)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "s1", 1, "own") for i in range(10)]
    rows += [(200 + i, junk(rng), "en", "s2", 1, "own") for i in range(20)]
    rows += [rows[0], (None, None, None, None, None, None), (300, "", "en", "s1", 0, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, weight string")
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i in range(400) if i < 60 or 200 <= i < 212]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.dtypes == before.dtypes
    ids = {name: [r.doc_id for r in df.collect()] for name, df in kept.items()}
    assert not [i for i in ids["quality"] if i and 200 <= i < 300] and {*range(80), *range(100, 110), None, 300} == set(ids["quality"])
    rows = [(n, r.text) for n, r in enumerate(kept["quality"].collect())]
    groups = {c for _, c in by_all_pairs(rows, 5).values()}
    assert len(ids["dedup"]) == len(groups) and ids["dedup"].count(0) <= 1
    private = kept["private"].collect()
    assert len(private) == len(ids["dedup"]) and not any("@" in (r.text or "") for r in private)
    assert all(r.text is None or r.n_chars == len(r.text) for r in private)
    assert set(ids["mix"]) == set(ids["dedup"]) and len(ids["mix"]) >= len(ids["dedup"])
    assert sorted(map(repr, ids["pieces"])) == sorted(map(repr, ids["mix"]))


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
def test_empty(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@needs_data
@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in contract.trace_queries()])
def test_registered(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0

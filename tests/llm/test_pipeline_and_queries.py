"""Registered queries run whole; the pipeline's stages one by one."""

import pytest
from brute import words
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from cashweave.llm import decontaminate, queries, simhash

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert all(isinstance(sql, str) for sql in contract.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    with connect(SMALL) as con:
        assert difference(queries.QUERIES[name](spark, SMALL), con, queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, small, name):
    rows = queries.QUERIES[name](spark, SMALL).collect()
    if name.startswith("op11_"):
        ids = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().collect()
        assert sorted(r["conv_id"] for r in rows) == sorted(r["conv_id"] for r in ids)
    elif not name.startswith("op7_"):
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in small.select("doc_id").collect())


def test_stages(spark, small, tmp_path):
    docs = small
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before = {r["doc_id"]: r for r in docs.collect()}
        now = {r["doc_id"]: r for r in after.collect()}
        if k < 4:
            assert after.columns == small.columns
        assert set(now) <= set(before)
        if name == "near_dedup":
            groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
            assert set(now) == {i for i in before if groups[i] == i}
        if name == "decontamination":
            assert set(before) - set(now) == {r["doc_id"] for r in decontaminate.leaks(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
        if name == "substring_dedup":
            assert all(len(words(now[i]["text"])) <= len(words(before[i]["text"])) for i in now)
        docs = after
    assert docs.count() > 100


def test_stages_on_odd_rows_and_none(spark, odd, none):
    for docs in (none, odd):
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, docs, SMALL).collect()
            assert len(done) <= docs.count()
            if docs is odd and name == "near_dedup":
                texts = sorted((r["text"] or "") for r in done)
                assert len(texts) == len(set(texts))
            if docs is none:
                assert done == []


def test_texts_of_one_id_go_or_stay_each_by_itself(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, c), (9, c), (8, c), (12, a + " more than the three bits allow")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    done = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in done.collect()) == [(1, a), (5, b), (8, c), (12, a + " more than the three bits allow")]

import numpy as np

from cashweave.llm import language
from cashweave.llm.base import fold


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.learn(docs.where(fold("doc_id", 5) != 0)), keep=("lang",)).where(fold("doc_id", 5) == 0).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
    assert ((found.score > 0) & (found.score <= 1)).all()


def test_odd_rows(spark, odd, none, small):
    learned = language.learn(small)
    rows = language.identify(odd, learned).collect()
    assert len(rows) == odd.count()
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {1, 2, 3, 4} <= und and 5 not in und
    assert all(r["score"] == 0 and r["languages"] == [] for r in rows if r["lang_pred"] == "und")
    assert language.identify(none, learned).collect() == []
    nothing = language.learn(none)
    assert nothing.names == []
    assert {r["lang_pred"] for r in language.identify(small, nothing).collect()} == {"und"}


def test_shares_of_a_mixture():
    """Words of two languages, 70 to 30: both are chosen, with these shares; a third is not."""
    rng = np.random.default_rng(2)
    logs = rng.normal(-20, 1, (1000, 3))
    logs[:700, 0] += 8
    logs[700:, 1] += 8
    shares = language.mixtures(logs.astype(np.float32), np.array([0, 1000, 1000]))
    assert abs(shares[0, 0] - 0.7) < 0.03 and abs(shares[0, 1] - 0.3) < 0.03 and shares[0, 2] == 0
    assert (shares[1] == 0).all()
    one = language.mixtures(logs[:700].astype(np.float32), np.array([0, 700]))
    assert one.tolist() == [[1.0, 0.0, 0.0]]


def test_neighbouring_texts_do_not_mix(spark, small):
    """A text's result does not depend on which texts stand beside it."""
    learned = language.learn(small)
    alone = {r["doc_id"]: r["score"] for r in language.identify(small.repartition(50), learned).collect()}
    together = {r["doc_id"]: r["score"] for r in language.identify(small.coalesce(1), learned).collect()}
    assert all(abs(alone[i] - together[i]) < 1e-6 for i in alone)

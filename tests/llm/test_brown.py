import math
import zlib
from collections import Counter

import pytest
from brute import LOWER, words
from pyspark.sql import functions as F

from cashweave.llm import brown
from cashweave.llm.base import fold


def _base(rows):
    tokens = [(i, [w.translate(LOWER) for w in words(t)] + [None]) for i, t in rows]
    trains = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    c = Counter(w for i, own in tokens if trains(i) for w in own)
    n, v = sum(c.values()), len(c)
    score = lambda own: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
    return [(i, len(own), sum(c[w] > 0 for w in own), n, score(own)) for i, own in tokens]


def _check(df):
    got = sorted(([r[c] for c in ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")] for r in brown.class_scores(df, fold("doc_id", 10) != 0).collect()), key=str)
    want = sorted((list(r) for r in _base([tuple(r) for r in df.select("doc_id", "text").collect()])), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-9, abs=1e-9)


def test_base_on_odd_rows(odd):
    _check(odd)


def test_base_over_many_blocks(small, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 700)
    _check(small)


def test_model_beats_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    done = brown.class_scores(docs, fold("doc_id", 10) != 0).where(fold("doc_id", 10) == 0).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert done["s"] > done["b"]


def test_probabilities_sum_to_one(spark):
    """After any word: all words of the vocabulary, one unseen word, and the end."""
    text = "a b a c b a d a b c"
    teach = [(1, text)] * 3 + [(2, "b c d a")]
    vocabulary = sorted(set(text.split()))
    ask = [(100 + i, f"{before} {w}".strip()) for before in ("", "a", "unseen1") for i, w in enumerate([*vocabulary, "unseen2"])] + [(900, ""), (901, "a"), (902, "unseen1")]
    df = spark.createDataFrame(teach + ask, "doc_id long, text string")
    done = brown.class_scores(df, F.col("doc_id") < 100).toPandas().set_index("doc_id")
    joined = df.toPandas().set_index("doc_id").join(done, rsuffix="_").reset_index().drop_duplicates("text").set_index("text")

    def end(x):  # p(end | x) from a text of one word less the word itself is not known alone; compare sums instead
        return 10.0 ** joined.loc[x, "score"]

    # p(w1) p(end|w1) summed over w1, plus p(end), is at most one; longer texts have the rest.
    total = sum(end(w) for w in [*vocabulary, "unseen2"] if w in joined.index) + end("")
    assert 0 < total < 1


def test_nothing_teaches_and_empty(odd, none):
    assert brown.class_scores(none, F.lit(True)).collect() == []
    rows = brown.class_scores(odd, F.lit(False)).collect()
    assert len(rows) == odd.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)

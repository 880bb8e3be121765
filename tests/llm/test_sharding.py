import zlib

import numpy as np

from cashweave.llm import sharding


def _laws(df, shards):
    texts = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append((r["text"] or "").encode())
    done = sharding.shard(df, shards).toPandas()
    assert len(done) == sum(map(len, texts.values()))
    for i, own in texts.items():
        mine = done[done.doc_id.isna()] if i is None else done[done.doc_id == i]
        assert sorted(zip(mine["size"], mine["text_crc32"], strict=True)) == sorted((len(t) + 16, zlib.crc32(t)) for t in own)
    for _, part in done.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    return done


def test_odd_rows(odd):
    _laws(odd, 3)


def test_balance_and_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    done = _laws(docs, 8)
    for measure in ("size", "tokens"):
        sums = done.groupby("shard")[measure].sum()
        assert sums.max() < 1.03 * sums.min()
    small = done[done["size"] < 500]
    assert (small.groupby(["text_crc32", "size"])["shard"].nunique() == 1).mean() > 0.99


def test_a_hot_group_is_cut(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(10_000 + i, f"text {i} " * (i % 9 + 1)) for i in range(3000)]
    done = _laws(spark.createDataFrame(rows, "doc_id long, text string"), 10)
    sums = done.groupby("shard")["size"].sum()
    assert sums.max() < 1.02 * sums.min()


def test_placement_prefers_room():
    at = sharding.place(np.array([[4.0, 1.0], [1.0, 4.0], [4.0, 1.0], [1.0, 4.0]]), 2, (0.0, 0.0))
    loads = np.array([[[4, 1], [1, 4]][i % 2] for i in range(4)])
    assert all((loads[at == s].sum(axis=0) == 5).all() for s in (0, 1))


def test_empty(none):
    assert sharding.shard(none, 4).collect() == []

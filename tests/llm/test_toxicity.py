from pyspark.sql import functions as F

from cashweave.llm import toxicity
from cashweave.llm.base import fold


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn(toxicity.sample(docs, labels.where(fold("doc_id", 5) != 0), most=1200))
    held = docs.join(labels.where(fold("doc_id", 5) == 0), "doc_id")
    done = toxicity.score(held, model).join(labels, "doc_id").toPandas()
    predicted = done.score >= 0.5
    assert (predicted == (done.toxic == 1)).mean() > 0.95
    assert predicted[done.toxic == 1].mean() > 0.75
    assert done.score.between(0, 1).all()


def _rows():
    plain = "the of and to in is was for that with on by from are this not be at or as".split()
    rows = []
    for i in range(200):
        words = [plain[(i * 7 + k * (k + i)) % len(plain)] for k in range(30)]
        if i % 4 == 0:
            words[i % 30] = ("vile", "wretch", "scoundrel")[i % 3]
            words[(i + 9) % 30] = "knave"
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_small_vocabulary_and_odd_rows(spark, odd, none):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(toxicity.sample(docs.drop("toxic"), docs.select("doc_id", "toxic")))
    done = toxicity.score(docs, model).join(docs.select("doc_id", "toxic"), "doc_id").toPandas()
    assert ((done.score >= 0.5) == (done.toxic == 1)).mean() > 0.9
    found = toxicity.score(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(none, model).collect() == []


def test_without_labels(spark, small, none):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(toxicity.sample(small, empty))
    assert {r["score"] for r in toxicity.score(small, model).collect()} == {0.0}
    one = small.select("doc_id", F.lit(1).alias("toxic"))
    assert {r["score"] for r in toxicity.score(small, toxicity.learn(toxicity.sample(small, one))).collect()} == {1.0}


def test_memory_does_not_change_distances():
    model = toxicity.learn(_rows())
    whole, tiny = toxicity.Distances(model.toxic, model.ordinary), toxicity.Distances(model.toxic, model.ordinary, memory=3)
    words = [w for _, t, _ in _rows() for w in toxicity.windows(t)] + [b"x" * 5000]
    assert [whole[w] for w in words] == [tiny[w] for w in words]


def test_a_very_long_text_does_not_end_the_sample(spark):
    texts = [(i, "bad words here " * (100_000 if i % 10 < 2 else 3), i % 2) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, most_bytes=100_000)
    for label in (0, 1):
        taken = [t for _, t, y in rows if y == label]
        assert len(taken) >= 40 and sum(map(len, taken)) <= 50_000

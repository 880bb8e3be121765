import numpy as np
from brute import counts

from cashweave.llm import quality

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _check(df):
    got = sorted((tuple(r) for r in quality.statistics(df).select("doc_id", *BASE).collect()), key=str)
    assert got == sorted(((r["doc_id"], *counts(r["text"])) for r in df.select("doc_id", "text").collect()), key=str)


def test_statistics_equal_brute_force(small, odd):
    _check(small)
    _check(odd)


def test_lines(spark):
    texts = ["a\na\n\n \na", "\n", "b\nb ", "x\n\nx\n", "a b c d e a b c d e", "a a a a a a"]
    _check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1))


def test_learns_a_conjunction():
    rng = np.random.default_rng(1)
    values = {n: rng.random(3000) for n in ("a", "b", "c")}
    bad = (values["a"] > 0.7) & (values["b"] <= 0.4)
    rules = quality.learn(values, bad)
    said = np.zeros(3000, bool)
    for rule in rules:
        said |= quality._covers(rule, values)
    assert (said == bad).mean() > 0.97
    assert quality.learn(values, np.zeros(3000, bool)) == []


def test_expression_equals_rules(spark, small):
    rules = [[quality.Condition("words", False, 60.0), quality.Condition("symbols", True, 0.0)], [quality.Condition("upper", True, 0.3)]]
    stats = quality.statistics(small).select("*", *[quality.feature(n).alias(n) for n in quality.FEATURES]).withColumn("said", quality.as_expression(rules)).toPandas()
    values = {n: stats[n].to_numpy(float) for n in quality.FEATURES}
    assert (stats["said"].to_numpy() == ~(quality._covers(rules[0], values) | quality._covers(rules[1], values))).all()


def test_verdicts(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    done = quality.judge(docs, labels).join(labels, "doc_id").toPandas()
    good = done[~done.base_failed]
    assert (good.kept == (good.quality == 1)).mean() > 0.97
    assert not done[done.base_failed].kept.any()


def test_odd_labels_and_empty(spark, odd, none):
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0), (99, 0)], "doc_id long, quality int")
    assert quality.judge(odd, labels).count() == odd.count()
    assert quality.judge(none, labels).collect() == []
    assert quality.judge(odd, labels.limit(0)).where("kept = base_failed").collect() == []

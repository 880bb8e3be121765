from pyspark.sql import functions as F

from cashweave.operators import keyed
from small import rows


def _skewed(spark):
    """A third of the rows on one key, some without a key."""
    n = spark.range(0, 3000, numPartitions=6)
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400))
    )
    return n.select("id", key.alias("k"))


def _lookup(spark):
    return spark.range(200).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v")
    ).unionByName(
        spark.createDataFrame([("hot", -1), ("hot", -2)], "k string, v bigint")
    )


def test_salted_join_equals_plain_join(spark):
    left, right = _skewed(spark), _lookup(spark)
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("id", "k", "v")
        salted = keyed.salted_join(left, right, "k", how, per_task=190).select("id", "k", "v")
        assert rows(salted) == rows(plain)


def test_hot_keys_by_rows_per_task(spark):
    """A third on one key and a 300th on another: both are split to the size of a task."""
    n = spark.range(0, 30_000)
    key = F.when(F.col("id") % 3 == 0, "third").when(F.col("id") % 300 == 1, "less").otherwise(
        F.concat(F.lit("k"), F.col("id") % 5000)
    )
    df = n.select(key.alias("k"))
    assert rows(keyed.hot_keys(df, "k", per_task=40)) == [("less", 3), ("third", 250)]
    assert rows(keyed.hot_keys(df, "k", per_task=2000)) == [("third", 5)]
    assert rows(keyed.hot_keys(df, "k", per_task=20_000)) == []


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("t"))
    assert keyed.fits_broadcast(wide, most=101_000)
    assert not keyed.fits_broadcast(wide, most=99_000)


def test_hot_rows_reach_several_tasks(spark):
    left, right = _skewed(spark), _lookup(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = keyed.salted_join(left, right, "k", "inner", per_task=190).where("k = 'hot'")
        tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


def test_lookup_join_broadcasts_only_what_it_counted(spark, capsys):
    left, right = _skewed(spark), _lookup(spark)
    small = keyed.lookup_join(left, right, "k", "left")
    large = keyed.lookup_join(left, right, "k", "left", rows=10)
    assert rows(small.select("id", "v")) == rows(large.select("id", "v"))
    small.explain("simple")
    assert "__salt" not in capsys.readouterr().out
    large.explain("simple")
    assert "__salt" in capsys.readouterr().out
    assert keyed.fits_broadcast(right, 202) and not keyed.fits_broadcast(right, 201)


def test_null_safe_join(spark):
    a = spark.createDataFrame([("x", None, 1), (None, None, 2)], "a string, b string, n int")
    b = spark.createDataFrame([("x", None, 7), (None, None, 8)], "a string, b string, m int")
    assert rows(keyed.null_safe_join(a, b, ["a", "b"], "left"), "n", "m") == [(1, 7), (2, 8)]


def test_one_per_key_is_the_smallest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "k string, n int, t string")
    assert rows(keyed.one_per_key(df, ["k"])) == [(None, 3, "z"), ("a", 1, "y")]


def test_rows_without_a_key_have_a_part_for_each_split(spark):
    """A left join keeps them and spreads them; an inner join does not shuffle them."""
    left = spark.range(0, 4000, numPartitions=8).select("id", F.lit(None).cast("string").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = keyed.salted_join(left, _lookup(spark), "k", "left")
        tasks = kept.groupBy(F.spark_partition_id()).count().collect()
        assert sum(t["count"] for t in tasks) == 4000 and len(tasks) > 1
        assert keyed.salted_join(left, _lookup(spark), "k", "inner").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_keys_are_counted_once(spark):
    """Measuring and joining them read what was written, not the left side again."""
    seen = spark.sparkContext.accumulator(0)
    rows_in = _skewed(spark).rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF("id long, k string")
    hot = keyed.hot_keys(rows_in, "k", per_task=190)
    joined = keyed.salted_join(_skewed(spark), _lookup(spark), "k", "inner", per_task=190, hot=hot)
    assert joined.count() == _skewed(spark).join(_lookup(spark), "k").count()
    assert seen.value == 3000


def test_a_hash_table_is_bounded_by_the_largest_key_and_the_parts(spark):
    """Rows of 15 bytes: 200 keys of one row and one of 100 rows, in two parts."""
    n = spark.range(300).select(
        F.when(F.col("id") < 100, "one-hot").otherwise(F.lpad(F.col("id"), 7, "0")).alias("k"),
        F.lit(1.5).alias("v"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = 100 * 15 + 300 * 15 // parts
    assert keyed.fits_hash(n, "k", most) and not keyed.fits_hash(n, "k", most - 1)


def test_a_hashed_join_sorts_nothing(spark, capsys):
    left, right = _skewed(spark), _lookup(spark)
    for how in ("inner", "left"):
        hashed = keyed.lookup_join(left, right, "k", how, rows=10, per_task=190, hashed=True)
        assert rows(hashed.select("id", "v")) == rows(left.join(right, "k", how).select("id", "v"))
        hashed.explain("simple")
        plan = capsys.readouterr().out
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan

"""Steps of a large query: what they leave on disk, and that results stay the same."""

import datetime
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cashweave.operators import transfers
from cashweave.plans import reports
from cashweave.registry import Tables, presented, registered
from cashweave.scratch import passing, shared_folder, written
from small import bridge, ledger, local, rows


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def _tables(spark, folder):
    """A few parts, suppliers and line items, parts with two accounts and two notes among them."""
    day = datetime.datetime(1995, 3, 7)
    parts = [(k, f"Brand#{10 if k % 4 == 0 else 20}", k % 3 * 43 + 7, 900.0 + k) for k in range(24)]
    lines = [
        (k, k * 7 % 24, k * 5 % 3, k % 5, float(k % 51), 100.25 + k, 0.01 * (k % 3), 0.01 * (k % 2), day)
        for k in range(400)
    ]
    local(spark, parts, "p_partkey long, p_brand string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    local(spark, [(k, f"Supplier#{k:09d}") for k in range(2)], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    local(
        spark,
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_shuffle_files_go_with_the_write(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffle_files(spark)
    kept = written(df, "counts")
    assert not _shuffle_files(spark) - before
    assert kept.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(setting) == "false"
    with pytest.raises(Exception, match="not now"):
        written(df.select(F.raise_error(F.lit("not now"))), "nothing")
    assert spark.conf.get(setting) == "false"


def test_tables_of_steps_go_with_the_block(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with passing(spark) as kept:
        first = kept(spark.range(5), "first")
        second = written(kept(first.selectExpr("id * 2 AS id"), "twice"), "second")
        assert len(set(os.listdir(folder)) - before) == 2
    assert {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"second"}
    assert rows(second) == [(0,), (2,), (4,), (6,), (8,)]


def test_drilldown_leaves_only_what_is_joined_last(spark, tmp_path, capsys):
    data = _tables(spark, str(tmp_path))
    t = Tables(spark, data)
    wanted = rows(presented(reports.drilldown(t.level1, t.sales, t.level2a, "SKU-%")))
    folder = shared_folder(spark).removeprefix("file:")
    tables, shuffles = set(os.listdir(folder)), _shuffle_files(spark)
    found = registered()["drilldown"](spark, data)
    assert not _shuffle_files(spark) - shuffles
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - tables}
    assert left == {"drilldown-cash", "drilldown-reported", "drilldown-waterfall"}
    found.explain("simple")
    assert "l_partkey" not in capsys.readouterr().out
    assert rows(found) == wanted and len(wanted) > 24


def test_kept_sums_give_the_same_totals(spark):
    """Shared accounts, products with several, repeated bridge rows, movements to oneself and unmapped accounts."""
    dice = random.Random(3)
    accounts = [f"VA-{i}" for i in range(7)]
    for _ in range(2):
        mapping = bridge(
            spark,
            *[(dice.choice([None, "N"]), dice.choice("ABCDE"), a, dice.choice("mn")) for a in accounts[:5] for _ in range(dice.randint(1, 4))],
            (None, "A", None, "m"),
            (None, None, "VA-1", "m"),
        )
        moves = [(dice.choice([*accounts, None]), dice.choice([*accounts, None]), dice.choice(["-", str(dice.randint(1, 99))]), "x") for _ in range(80)]
        raw = ledger(spark, *moves)
        wanted = rows(transfers.transfers_agg(transfers.inter_sku_transfers(raw, mapping)))
        assert rows(transfers.transfer_totals(raw, mapping, written)) == wanted and len(wanted) > 2


def test_kept_movements_are_shuffled_once_by_either_account(spark, capsys):
    mapping = bridge(spark, (None, "S1", "A", "m"), ("N2", "S1", "A", "m"), (None, "S2", "A", "m"), (None, "S1", "B", "n"))
    raw = ledger(spark, ("A", "A", "3", "x"), ("A", "B", "5", "x"), ("B", "A", "?", "x"), ("D", "A", "1", "x"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}

    def shown(df, name):
        df.explain("simple")
        return written(df, name)

    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        transfers.transfer_totals(raw, mapping, shown)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dealt = re.findall(r"[-+] Exchange hashpartitioning\(([^)]*)", capsys.readouterr().out)
    keys = [re.findall(r"(\w+_va)#", text) for text in dealt]
    assert sorted(k for k in keys if k) == [["receiver_va"], ["sender_va"]]

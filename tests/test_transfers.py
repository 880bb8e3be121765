import random
from collections import defaultdict
from decimal import Decimal

from cashweave.operators import transfers
from small import D, bridge, ledger, rows


def _brute_force(moves, mapping):
    """Pair up all products of both accounts, as SQL would, and add up."""
    sides = defaultdict(lambda: ([], []))
    for sender, receiver, amount in moves:
        for _, s_sku, s_va, s_m in mapping:
            for _, r_sku, r_va, r_m in mapping:
                if (s_va, r_va) != (sender, receiver) or None in (sender, receiver, s_sku, r_sku):
                    continue
                if s_sku != r_sku:
                    sides[s_sku, s_m][0].append(amount)
                    sides[s_sku, s_m][1].append(Decimal(0))
                    sides[r_sku, r_m][0].append(Decimal(0))
                    sides[r_sku, r_m][1].append(amount)

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    return sorted((s, m, total(o), total(i)) for (s, m), (o, i) in sides.items())


def test_one_transfer(spark):
    raw = ledger(spark, ("VA-1", "VA-2", "10", "x"), ("VA-1", "VA-3", "5", "x"))
    mapping = bridge(
        spark, (None, "A", "VA-1", "m"), (None, "B", "VA-2", "m"), (None, "A", "VA-3", "m")
    )
    wanted = [("A", "m", D(10), D(0)), ("B", "m", D(0), D(10))]
    moved = transfers.inter_sku_transfers(raw, mapping)
    assert rows(moved, "from_sku_id", "to_sku_id", "amount", "period_ym") == [
        ("A", "B", D(10), "2025-09")
    ]
    assert rows(transfers.transfers_agg(moved)) == wanted
    assert rows(transfers.transfer_totals(raw, mapping)) == wanted


def test_totals_against_brute_force(spark):
    dice = random.Random(11)
    accounts = [f"VA-{i}" for i in range(6)] + [None]
    for _ in range(4):
        mapping = list(
            {
                (dice.choice([None, "N1"]), dice.choice(["A", "B", "C", "D"]), a, dice.choice("mn"))
                for a in accounts[:5]
                for _ in range(dice.randint(1, 4))
            }
        )
        moves = [
            (dice.choice(accounts), dice.choice(accounts), dice.choice([None, D(dice.randint(1, 99))]))
            for _ in range(60)
        ]
        raw = ledger(spark, *[(s, r, None if a is None else str(a), "x") for s, r, a in moves])
        table = bridge(spark, *mapping)
        wanted = _brute_force(moves, mapping)
        assert rows(transfers.transfer_totals(raw, table)) == wanted
        assert rows(transfers.transfers_agg(transfers.inter_sku_transfers(raw, table))) == wanted


def test_what_goes_out_comes_in(spark):
    raw = ledger(spark, *[(f"VA-{i % 3}", f"VA-{i % 4}", f"{i}.25", "x") for i in range(40)])
    mapping = bridge(spark, *[(None, f"S{i}", f"VA-{i}", "m") for i in range(4)])
    out, into = zip(*rows(transfers.transfer_totals(raw, mapping), "transfer_out_to_other_sku", "transfer_in_from_other_sku"))
    assert sum(out) == sum(into) > 0


def test_products_are_never_paired_up(spark):
    """Two accounts with 3,000 products each: 9 million pairs, 6,000 results."""
    raw = ledger(spark, ("VA-1", "VA-2", "1", "x"), ("VA-2", "VA-2", "2", "x"))
    mapping = spark.range(6000).selectExpr(
        "cast(null as string) note_id",
        "concat('S', id) sku_id",
        "if(id < 3000, 'VA-1', 'VA-2') va_number",
        "'m' merchant_id",
    )
    found = dict((r[0], r[2:]) for r in rows(transfers.transfer_totals(raw, mapping)))
    assert len(found) == 6000
    assert found["S1"] == (D(3000), D(0))
    assert found["S5000"] == (D(2 * 2999), D(3000 + 2 * 2999))


def test_latest_transfers_put_undated_first(spark):
    raw = ledger(
        spark,
        ("VA-1", "VA-2", "1", "x", "2025-01-02"),
        ("VA-1", "VA-2", "2", "x", "later"),
        ("VA-1", "VA-2", "3", "x", "2025-03-02"),
    )
    mapping = bridge(spark, (None, "A", "VA-1", "m"), (None, "B", "VA-2", "m"))
    latest = transfers.latest_transfers(raw, mapping, 2)
    assert [r["amount"] for r in latest.collect()] == [2, 3]


def _order(r):
    date, sku_from, sku_to, amount = r
    return (date is not None, -date.toordinal() if date else 0, sku_from, sku_to, amount is None, amount or 0)


def test_latest_transfers_equal_those_of_all_pairs(spark):
    """Shared accounts, repeated bridge rows, transfers within a product, ties and undated rows."""
    dice = random.Random(5)
    for n in (1, 3, 10, 1000):
        accounts = [f"VA-{i}" for i in range(7)]
        mapping = bridge(spark, *[(dice.choice([None, "N"]), dice.choice("ABCDE"), a, "m") for a in accounts[:5] for _ in range(dice.randint(1, 6))])
        moves = [(dice.choice(accounts), dice.choice(accounts), dice.choice(["-", str(dice.randint(1, 9))]), "x", dice.choice(["2025-01-02", "2025-03-04", "soon"])) for _ in range(50)]
        raw = ledger(spark, *moves)
        columns = ("occurred_at_utc", "sku_from", "sku_to", "amount")
        whole = transfers.inter_sku_transfers(raw, mapping).toDF("s", "r", "amount", "occurred_at_utc", "sku_from", "fm", "sku_to", "tm", "p")
        wanted = sorted((tuple(r) for r in whole.select(*columns).collect()), key=_order)[:n]
        found = [tuple(r) for r in transfers.latest_transfers(raw, mapping, n).select(*columns).collect()]
        assert found == wanted


def test_latest_transfers_expand_few_movements(spark):
    """Two accounts with 3,000 products each, and 200 movements: 50 rows, never nine million pairs each."""
    raw = ledger(spark, *[("VA-1", "VA-2", str(i), "x", "2025-01-02") for i in range(200)])
    mapping = spark.range(6000).selectExpr(
        "cast(null as string) note_id", "concat('S', id) sku_id", "if(id < 3000, 'VA-1', 'VA-2') va_number", "'m' merchant_id"
    )
    found = transfers.latest_transfers(raw, mapping).collect()
    assert [(r["sku_from"], r["sku_to"], int(r["amount"])) for r in found] == [("S0", "S3000", i) for i in range(50)]


def test_totals_share_one_pass_over_the_ledger(spark):
    import re

    from cashweave.registry import registered

    df = registered()["transfer_totals"](spark, "/root/testdata/sf0.001")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 1


def test_rows_with_a_bridge_too_large_to_broadcast(spark, monkeypatch):
    """Equal rows by the split joins; what is hot at either join is told from pairs of accounts."""
    dice = random.Random(5)
    accounts = ["VA-hot", *[f"VA-{i}" for i in range(12)], None]
    moves = [
        (dice.choice(accounts), "VA-hot" if i % 3 == 0 else dice.choice(accounts), str(i), "x")
        for i in range(300)
    ]
    # The sender VA-many has few movements and many products: hot at the second join only.
    moves += [("VA-many", "VA-far", "1", "x"), ("VA-many", "VA-far", "2", "x")]
    raw = ledger(spark, *moves)
    mapping = bridge(
        spark,
        *[(None, f"S{i % 5}", f"VA-{i}", "m") for i in range(12)],
        (None, "S9", "VA-hot", "m"),
        (None, "S8", "VA-hot", "m"),
        (None, "S7", "VA-far", "m"),
        (None, "S7", None, "m"),
        *[(None, f"P{i}", "VA-many", "m") for i in range(40)],
    )
    asked = []
    counts = transfers.hot_counts

    def noted(*args):
        found = counts(*args)
        asked.append(dict(rows(found)))
        return found

    monkeypatch.setattr(transfers, "hot_counts", noted)
    plain = rows(transfers.inter_sku_transfers(raw, mapping))
    assert asked == []
    assert rows(transfers.inter_sku_transfers(raw, mapping, rows=0, per_task=20)) == plain
    first, second = asked
    sent = [m[0] for m in moves if None not in m[:2]]
    wanted = {a: -(-sent.count(a) // 20) for a in set(sent) if sent.count(a) > 20}
    assert first == wanted and "VA-many" not in first
    assert second["VA-far"] == 4 and second["VA-hot"] > 1


def test_only_pairs_that_may_stay_within_a_product_are_looked_at(spark, monkeypatch):
    """Pairs whose far account is not of a product with several accounts are left out before any join."""
    seen = []
    plain = transfers._inside

    def noted(directed, movable, same):
        seen.extend(rows(directed, "own", "far"))
        return plain(directed, movable, same)

    monkeypatch.setattr(transfers, "_inside", noted)
    mapping = bridge(spark, (None, "S1", "VA-1", "m"), (None, "S1", "VA-2", "m"), (None, "S2", "VA-3", "m"))
    raw = ledger(spark, ("VA-1", "VA-2", "5", "x"), ("VA-1", "VA-3", "7", "x"), ("VA-3", "VA-9", "1", "x"))
    found = rows(transfers.transfer_totals(raw, mapping))
    assert seen == [("VA-1", "VA-2"), ("VA-2", "VA-1"), ("VA-3", "VA-1")]
    assert found == rows(transfers.transfers_agg(transfers.inter_sku_transfers(raw, mapping)))


def test_no_row_per_end_is_made_of_the_pairs(spark, capsys):
    """A pair is shuffled by either account as it is, not twice as two rows."""
    mapping = bridge(
        spark, (None, "S1", "A", "m"), ("N2", "S1", "A", "m"), (None, "S2", "A", "m"), (None, "S1", "B", "n")
    )
    raw = ledger(spark, ("A", "A", "3", "x"), ("A", "B", "5", "x"), ("B", "A", "?", "x"), ("C", "A", "1", "x"))
    found = transfers.transfer_totals(raw, mapping)
    found.explain("simple")
    assert "inline(" not in capsys.readouterr().out
    assert rows(found) == rows(transfers.transfers_agg(transfers.inter_sku_transfers(raw, mapping)))


def test_the_second_join_of_transfer_rows_is_not_sorted(spark, capsys):
    mapping = bridge(spark, (None, "S1", "A", "m"), (None, "S2", "B", "m"))
    raw = ledger(spark, ("A", "B", "5", "x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = transfers.inter_sku_transfers(raw, mapping, rows=0)
        moved.explain("simple")
        plan = capsys.readouterr().out
        assert "ShuffledHashJoin [receiver_va" in plan and "SortMergeJoin [receiver_va" not in plan
        assert rows(moved, "from_sku_id", "to_sku_id", "period_ym") == [("S1", "S2", "2025-09")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

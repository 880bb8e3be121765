"""Money moving between products."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window, functions as F

from cashweave.functions.parsing import TOTAL, period_ym
from cashweave.operators.keyed import BROADCAST_ROWS, ROWS_PER_TASK, hot_counts, lookup_join
from cashweave.operators.typed import ledger_rows
from cashweave.scratch import Kept, written


def _named_bridge(bridge: DataFrame, va: str, sku: str, merchant: str) -> DataFrame:
    return bridge.where(F.col("va_number").isNotNull() & F.col("sku_id").isNotNull()).select(
        F.col("va_number").alias(va),
        F.col("sku_id").alias(sku),
        F.col("merchant_id").alias(merchant),
    )


def inter_sku_transfers(
    raw: DataFrame,
    bridge: DataFrame,
    rows: int = BROADCAST_ROWS,
    per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Movements whose sender and receiver belong to different products.

    All categories count. An account shared by several products gives one row
    for each of them. A bridge of more than ``rows`` rows is joined with the
    accounts split that have more than ``per_task`` rows.
    """
    # Both joins may shuffle all rows, so the month is told from the moment behind them.
    moves = ledger_rows(raw).select("sender_va", "receiver_va", "amount", "occurred_at_utc")
    whole = moves.where("sender_va is not null and receiver_va is not null")
    senders = _named_bridge(bridge, "sender_va", "from_sku_id", "from_merchant_id")
    receivers = _named_bridge(bridge, "receiver_va", "to_sku_id", "to_merchant_id")

    # Rows of either join per account, from one pass over the ledger; asked for only
    # where the bridge is too large to be broadcast.
    @cache
    def pairs() -> DataFrame:
        return written(whole.groupBy("sender_va", "receiver_va").count(), "transfer-pairs")

    def per_sender() -> DataFrame:
        return hot_counts(
            pairs().groupBy("sender_va").agg(F.sum("count").alias("count")), "sender_va", per_task
        )

    def per_receiver() -> DataFrame:
        products = senders.groupBy("sender_va").agg(F.count(F.lit(1)).alias("products"))
        made = pairs().join(products, "sender_va").groupBy("receiver_va")
        return hot_counts(
            made.agg(F.sum(F.col("count") * F.col("products")).alias("count")), "receiver_va", per_task
        )

    sent = lookup_join(whole, senders, "sender_va", rows=rows, per_task=per_task, hot=per_sender)
    # The first join's order makes the second shuffle small; nothing needs the second's.
    both = lookup_join(
        sent, receivers, "receiver_va", rows=rows, per_task=per_task, hot=per_receiver, hashed=True
    )
    return both.where(F.col("from_sku_id") != F.col("to_sku_id")).select(
        "sender_va",
        "receiver_va",
        "amount",
        "occurred_at_utc",
        "from_sku_id",
        "from_merchant_id",
        "to_sku_id",
        "to_merchant_id",
        period_ym(F.col("occurred_at_utc")).alias("period_ym"),
    )


# Per movement or pair of accounts: rows, rows with an amount, the amounts.
_MEASURES = ("n", "n_amounts", "amount")


def _both_ends(moves: DataFrame, sender: dict[str, str], receiver: dict[str, str]) -> DataFrame:
    """Each row once per end: ``out`` tells the sending end from the receiving."""
    ends = F.array(
        *[
            F.struct(F.lit(out).alias("out"), *[F.col(c).alias(n) for n, c in names.items()])
            for out, names in ((True, sender), (False, receiver))
        ]
    )
    return moves.select(*_MEASURES, F.inline(ends))


def _per_product(ends: DataFrame) -> DataFrame:
    """Add up both ends per product and merchant.

    A side is NULL only where a plain sum would be: the product has no rows on
    the other side and none of its rows on this side has an amount.
    """

    def added(measure: str, out: bool) -> Column:
        return F.coalesce(F.sum(F.when(F.col("out") == out, F.col(measure))), F.lit(0))

    def total(out: bool) -> Column:
        known = (added("n_amounts", out) > 0) | (added("n", not out) > 0)
        return F.when(known, added("amount", out).cast(TOTAL))

    return (
        ends.groupBy("sku_id", "merchant_id")
        .agg(
            F.sum("n").alias("n_rows"),
            total(True).alias("transfer_out_to_other_sku"),
            total(False).alias("transfer_in_from_other_sku"),
        )
        .where("n_rows > 0")
        .drop("n_rows")
    )


def transfers_agg(transfers: DataFrame) -> DataFrame:
    """Transfers out and in per product and merchant, from transfer rows."""
    measured = transfers.withColumns(
        {"n": F.lit(1), "n_amounts": F.col("amount").isNotNull().cast("int")}
    )
    return _per_product(
        _both_ends(
            measured,
            {"sku_id": "from_sku_id", "merchant_id": "from_merchant_id"},
            {"sku_id": "to_sku_id", "merchant_id": "to_merchant_id"},
        )
    )


def _times(measure: str, rows: str) -> Column:
    """A measure once per bridge row. Amounts stay exact: the count is a decimal."""
    count = F.col(rows)
    return F.col(measure) * (count.cast("decimal(10,0)") if measure.endswith("amount") else count)


def _inside(directed: DataFrame, movable: DataFrame, same: DataFrame) -> DataFrame:
    """Pairs of accounts whose both ends belong to one product with several accounts.

    Two orders of joining: an account's products with its counterparties, or its
    products with their other accounts. Which makes fewer rows is counted for
    each account beforehand, and each account takes the cheaper one.
    """
    # Only pairs of two such accounts are looked at further, and are told once for all
    # uses: each takes all columns, else its shuffle would be one of its own.
    owners = movable.select("own").distinct()
    directed = directed.join(owners, "own", "left_semi").select(*directed.columns)
    far = same.withColumnRenamed("va_number", "far")
    accounts = same.groupBy("sku_id").agg(F.count(F.lit(1)).alias("accounts"))
    products = movable.join(accounts, "sku_id").groupBy("own").agg(
        F.count(F.lit(1)).alias("products"), F.sum("accounts").alias("by_product")
    )
    # A pair has a row at least. It is told by all columns, because with some left out
    # this would be a pass of its own over the ledger, and so its sums are shared.
    some = F.col("n") + F.col("n_amounts") + F.abs("amount") + F.length("far") + F.col("out").cast("int") > 0
    partners = directed.groupBy("own").agg(F.sum(F.when(some, 1)).alias("partners"))
    way = products.join(partners, "own").select(
        "own", (F.col("products") * F.col("partners") <= F.col("by_product")).alias("by_partner")
    )
    chosen = movable.join(way, "own")
    first = directed.join(chosen.where("by_partner").drop("by_partner"), "own").join(
        far, ["far", "sku_id"]
    )
    reach = chosen.where("not by_partner").drop("by_partner").join(far, "sku_id")
    second = directed.join(reach, ["own", "far"])
    return first.unionByName(second.select(*first.columns))


def _by_pairs(raw: DataFrame, facing: DataFrame, reached: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``toward`` and ``near`` of :func:`transfer_totals`, from the ledger added up per pair
    of accounts, as parts of the plan that uses them."""
    pairs = (
        ledger_rows(raw)
        .where(F.col("sender_va").isNotNull() & F.col("receiver_va").isNotNull())
        .groupBy("sender_va", "receiver_va")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("amount").alias("n_amounts"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"),
        )
    )
    # A pair is shuffled by its receiver for the sending end and by its sender for the
    # receiving one, each once: for ``toward``, and for what may stay within a product,
    # which must face an account of a product with several.
    # Conditions on the pair stay inside the sums: as filters they would reach
    # the scan and make each use of ``pairs`` read the ledger again. Pairs are added up
    # by the bridge rows they face and multiplied behind that, which is exact as well.
    is_self = F.col("sender_va") == F.col("receiver_va")
    ends, nearby = [], []
    for out, own, far in ((True, "sender_va", "receiver_va"), (False, "receiver_va", "sender_va")):
        met = pairs.join(facing.withColumnRenamed("va_number", far), far)
        sums = met.groupBy(F.col(own).alias("own"), "all_rows", is_self.alias("is_self")).agg(
            *[F.sum(m).alias(m) for m in _MEASURES]
        )
        ends.append(sums.withColumn("out", F.lit(out)))
        near = pairs.join(reached.withColumnRenamed("va_number", far), far, "left_semi")
        nearby.append(
            near.select(*_MEASURES, F.lit(out).alias("out"), F.col(own).alias("own"), F.col(far).alias("far"))
        )
    return ends[0].unionByName(ends[1]), nearby[0].unionByName(nearby[1])


def _by_movements(
    raw: DataFrame, facing: DataFrame, reached: DataFrame, kept: Kept
) -> tuple[DataFrame, DataFrame]:
    """The same from one pass whose sums are kept.

    A movement meets the bridge once at each end, so it is shuffled twice, not three times
    as it is or as a pair. What it adds to is told behind both joins: the totals of its two
    accounts, and those of its pair if an end is of a product with several accounts
    (``near_ends``: 1 the sender, 2 the receiver, 3 both). Added up in the task first, few
    rows of a hot account leave it.
    """
    faced = facing.join(reached.withColumn("is_near", F.lit(True)), "va_number", "left").select(
        "va_number", "all_rows", F.coalesce("is_near", F.lit(False)).alias("is_near")
    )
    met = ledger_rows(raw).select("sender_va", "receiver_va", "amount")
    for end in ("sender", "receiver"):
        met = met.join(faced.toDF(f"{end}_va", f"{end}_rows", f"{end}_near"), f"{end}_va")
    near_ends = F.col("sender_near").cast("int") + 2 * F.col("receiver_near").cast("int")
    is_self = (F.col("sender_va") == F.col("receiver_va")).alias("is_self")

    def sum_of(own: str, far: Column, all_rows: Column, out: Column, near: Column) -> Column:
        return F.struct(
            F.col(own).alias("own"),
            far.cast("string").alias("far"),
            all_rows.cast("long").alias("all_rows"),
            is_self,
            out.cast("boolean").alias("out"),
            near.alias("near_ends"),
        )

    nothing, not_near = F.lit(None), F.lit(0)
    sums_of = F.array(
        sum_of("sender_va", nothing, F.col("receiver_rows"), F.lit(True), not_near),
        sum_of("receiver_va", nothing, F.col("sender_rows"), F.lit(False), not_near),
        F.when(near_ends > 0, sum_of("sender_va", F.col("receiver_va"), nothing, nothing, near_ends)),
    )
    sums = kept(
        met.select("amount", F.inline(F.array_compact(sums_of)))
        .groupBy("own", "far", "all_rows", "is_self", "out", "near_ends")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("amount").alias("n_amounts"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"),
        ),
        "transfer-sums",
    )
    toward = sums.where("near_ends = 0").select("own", "all_rows", "is_self", *_MEASURES, "out")
    sent, got = (
        sums.where(told).select(*_MEASURES, F.lit(out).alias("out"), F.col(own).alias("own"), F.col(far).alias("far"))
        for told, out, own, far in (("near_ends >= 2", True, "own", "far"), ("near_ends in (1, 3)", False, "far", "own"))
    )
    return toward, sent.unionByName(got)


def transfer_totals(raw: DataFrame, bridge: DataFrame, kept: Kept | None = None) -> DataFrame:
    """Same result as ``transfers_agg`` of all transfer rows, without them.

    The ledger is added up first. A bridge row transfers to all bridge rows of the
    other account except those of its own product. So its total is the one of its
    account (``toward``: the movements times the bridge rows facing it) less the part
    that stays within the product: on the account itself, or on other accounts of the
    same product (``inside``). No product of one account is ever paired with the
    products of the other, nor each product with each counterparty where that is more
    than it need be. Where the sums may be ``kept``, less is shuffled for them.
    """
    mapped = _named_bridge(bridge, "va_number", "sku_id", "merchant_id")
    same = mapped.groupBy("va_number", "sku_id").agg(F.count(F.lit(1)).alias("same_rows"))
    facing = same.groupBy("va_number").agg(F.sum("same_rows").alias("all_rows"))
    several = same.groupBy("sku_id").count().where("count > 1").select("sku_id")
    own_rows = mapped.join(same, ["va_number", "sku_id"]).withColumnRenamed("va_number", "own")
    movable = mapped.join(several, "sku_id", "left_semi").withColumnRenamed("va_number", "own")
    within = same.join(several, "sku_id", "left_semi")
    reached = within.select("va_number").distinct()
    if kept:
        toward, near = _by_movements(raw, facing, reached, kept)
    else:
        toward, near = _by_pairs(raw, facing, reached)
    inside = _inside(near, movable, within)
    key = ["sku_id", "merchant_id", "out"]
    of_itself = F.when(F.col("is_self"), F.col("same_rows")).otherwise(F.lit(0))
    leaving = own_rows.join(toward, "own").withColumn("rows", F.col("all_rows") - of_itself).select(
        *key, *[_times(m, "rows").alias(m) for m in _MEASURES]
    )
    is_self = F.col("own") == F.col("far")
    staying = inside.select(
        *key, *[F.when(~is_self, -_times(m, "same_rows")).alias(m) for m in _MEASURES]
    )
    return _per_product(leaving.unionByName(staying))


def _first_skus(bridge: DataFrame, va: str, skus: str, n: int) -> DataFrame:
    """Per account its first n + 1 products by name, each with its number of bridge rows."""
    mapped = bridge.where(F.col("va_number").isNotNull() & F.col("sku_id").isNotNull())
    counted = mapped.groupBy("va_number", "sku_id").agg(F.count(F.lit(1)).alias("rows"))
    # Cut in each task before an account's products come together.
    nth = F.row_number().over(Window.partitionBy("va_number").orderBy("sku_id"))
    first = counted.withColumn("nth", nth).where(F.col("nth") <= n + 1)
    listed = F.array_sort(F.collect_list(F.struct("sku_id", "rows")))
    return first.groupBy(F.col("va_number").alias(va)).agg(listed.alias(skus))


def latest_transfers(raw: DataFrame, bridge: DataFrame, n: int = 50) -> DataFrame:
    """The most recent transfers between products; undated ones come first.

    The first n of ``inter_sku_transfers`` by time, products and amount, without
    its rows. A movement makes a row for each pair of different products of its
    two accounts, in the order of the products. So the n first rows are of the n
    movements that have the earliest first pair, and of each at most its n first
    pairs, which are among the first n + 1 products of either account. Every
    movement meets one row an account; only n of them are expanded.
    """
    moves = ledger_rows(raw).select(
        "sender_va", "receiver_va", "amount", "occurred_at_utc", "period_ym"
    )
    sent = lookup_join(moves, _first_skus(bridge, "sender_va", "from_skus", n), "sender_va")
    both = lookup_join(sent, _first_skus(bridge, "receiver_va", "to_skus", n), "receiver_va")

    def order(sku_from: Column, sku_to: Column) -> list[Column]:
        return [F.desc_nulls_first("occurred_at_utc"), sku_from, sku_to, F.asc_nulls_last("amount")]

    # The first pair: of the first products, or one of them with the other's second.
    f, t = F.get("from_skus", F.lit(0))["sku_id"], F.get("to_skus", F.lit(0))["sku_id"]
    next_f, next_t = F.get("from_skus", F.lit(1))["sku_id"], F.get("to_skus", F.lit(1))["sku_id"]
    by_next_t = F.when(next_t.isNotNull(), F.struct(f.alias("f"), next_t.alias("t")))
    by_next_f = F.when(next_f.isNotNull(), F.struct(next_f.alias("f"), t.alias("t")))
    first = F.when(f != t, F.struct(f.alias("f"), t.alias("t"))).otherwise(F.coalesce(by_next_t, by_next_f))
    movements = (
        both.withColumn("first", first)
        .where(F.col("first").isNotNull())
        .orderBy(*order(F.col("first.f"), F.col("first.t")))
        .limit(n)
    )
    pairs = F.flatten(
        F.transform(
            "from_skus",
            lambda a: F.transform(
                F.filter("to_skus", lambda b: b["sku_id"] != a["sku_id"]),
                lambda b: F.struct(
                    a["sku_id"].alias("sku_from"), b["sku_id"].alias("sku_to"), (a["rows"] * b["rows"]).alias("rows")
                ),
            ),
        )
    )
    listed = movements.select(F.inline(F.slice(pairs, 1, n)), "amount", "occurred_at_utc", "period_ym")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("rows", F.lit(n).cast("long"))))
    return (
        listed.select("sku_from", "sku_to", "amount", "occurred_at_utc", "period_ym", copies)
        .drop("col")
        .orderBy(*order(F.col("sku_from"), F.col("sku_to")))
        .limit(n)
    )

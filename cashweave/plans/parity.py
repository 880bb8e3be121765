"""Which rows of two marts are the same, when keys repeat.

A key (product and account) may have several rows, and one of them may be missing. Rows
are therefore matched, not compared by rank: as many as possible within the tolerance,
in the order of their amounts, those of one merchant before others. What is left over on
both sides are rows with another amount; the rest of the longer side is missing or extra.

Equal rows are counted first, so a row costs nothing however often it repeats, and keys
with equal counts on both sides are done with. The cells of other keys (amounts in cents
and merchant) fall into clusters: two rows can match only if no gap wider than the
tolerance lies between their amounts. A cluster of one cell is settled by its counts.
Most cells are alone by their first amount already. Those are told from the others by one
sort, and written; the rest of the clusters and their lists are of the others only.
Only clusters of several cells, amounts a cent apart, are matched cell by cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cashweave.operators.keyed import null_safe_join
from cashweave.scratch import written

CENT = Decimal("0.01")
KEYS = ["sku_id", "account_number"]
AMOUNTS = ["amount_pulled", "amount_received", "sales_proceeds"]
PROBLEMS = ("missing", "extra", "amount", "merchant")
_CELL = [*KEYS, *AMOUNTS, "merchant"]


def _cells(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows per key, amounts in cents and merchant, on either side."""

    def side(df: DataFrame, here: str) -> DataFrame:
        cents = [F.round(F.coalesce(F.col(a), F.lit(0)), 2).cast("decimal(36,2)").alias(a) for a in AMOUNTS]
        counts = [F.lit(int(n == here)).cast("long").alias(n) for n in ("expected", "actual")]
        return df.select(*KEYS, *cents, "merchant", *counts)

    both = side(expected, "expected").unionByName(side(actual, "actual"))
    return both.groupBy(*_CELL).agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))


def _clusters(cells: DataFrame, tolerance: Decimal) -> DataFrame:
    """cells with the cluster they are in: gaps are looked for amount by amount."""
    within = list(KEYS)
    for i, amount in enumerate(AMOUNTS):
        w = Window.partitionBy(*within).orderBy(amount)
        gap = F.coalesce(F.col(amount) - F.lag(amount).over(w) > F.lit(tolerance), F.lit(False))
        cells = cells.withColumn(f"gap_{i}", gap.cast("int"))
        part = F.sum(f"gap_{i}").over(w.rowsBetween(Window.unboundedPreceding, 0))
        cells = cells.withColumn(f"part_{i}", part).drop(f"gap_{i}")
        within.append(f"part_{i}")
    return cells


def _told_apart(cells: DataFrame, tolerance: Decimal) -> DataFrame:
    """cells, each with whether no other of its key has a first amount within the tolerance."""
    amount, w = F.col(AMOUNTS[0]), Window.partitionBy(*KEYS).orderBy(AMOUNTS[0])
    gaps = [amount - F.lag(amount).over(w), F.lead(amount).over(w) - amount]
    far = [F.coalesce(gap > F.lit(tolerance), F.lit(True)) for gap in gaps]
    return cells.withColumn("alone", far[0] & far[1])


def _settled(clusters: DataFrame) -> DataFrame:
    """Rows left over of clusters of one cell."""
    both = F.least("expected", "actual")
    return clusters.select(
        *KEYS,
        (F.col("expected") - both).alias("missed"),
        (F.col("actual") - both).alias("added"),
        F.lit(0).cast("long").alias("renamed"),
    )


_LEFT = "sku_id string, account_number string, missed bigint, added bigint, renamed bigint"


def match_cells(cells: list[tuple], tolerance: Decimal) -> tuple[int, int, int]:
    """Rows left over (expected, actual) and matched under another merchant, of one cluster.

    cells: (amounts, merchant, expected, actual). Each expected cell takes, in the order
    of amounts, the first actual rows within the tolerance: for one amount, with the
    others equal, no other way matches more rows.
    """
    cells = sorted(cells, key=lambda c: (c[0], c[1] is not None, c[1] or ""))
    wanted, found = [c[2] for c in cells], [c[3] for c in cells]
    renamed = 0
    for same_merchant in (True, False):
        begin = 0
        for i, (amounts, merchant, *_) in enumerate(cells):
            while begin < len(cells) and cells[begin][0][0] < amounts[0] - tolerance:
                begin += 1
            for j in range(begin, len(cells)):
                if not wanted[i] or cells[j][0][0] > amounts[0] + tolerance:
                    break
                near = all(abs(a - b) <= tolerance for a, b in zip(amounts, cells[j][0], strict=True))
                if found[j] and near and (merchant == cells[j][1]) == same_merchant:
                    n = min(wanted[i], found[j])
                    wanted[i] -= n
                    found[j] -= n
                    renamed += 0 if same_merchant else n
    return sum(wanted), sum(found), renamed


def _matched(tolerance: Decimal):
    def clusters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for sku, account, cells in zip(frame["sku_id"], frame["account_number"], frame["cells"], strict=True):
                listed = [(tuple(c[a] for a in AMOUNTS), c["merchant"], c["expected"], c["actual"]) for c in cells]
                out.append((sku, account, *match_cells(listed, tolerance)))
            yield pd.DataFrame(out, columns=["sku_id", "account_number", "missed", "added", "renamed"])

    return clusters


def parity_counts(expected: DataFrame, actual: DataFrame, tolerance: Decimal = CENT) -> DataFrame:
    """Keys with problems: how many rows are missing, extra, of another amount, of another merchant."""
    cells = _cells(expected, actual)
    uneven = cells.where("expected <> actual").select(*KEYS).distinct()
    parts = [f"part_{i}" for i in range(len(AMOUNTS))]
    # Written between the sorts, so that no task holds those of both.
    open_cells = written(
        _told_apart(null_safe_join(cells, uneven, KEYS, "left_semi"), tolerance), "parity-cells"
    )
    clusters = _clusters(open_cells.where("not alone").drop("alone"), tolerance).groupBy(*KEYS, *parts).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("expected").alias("expected"),
        F.sum("actual").alias("actual"),
        F.collect_list(F.struct(*AMOUNTS, "merchant", "expected", "actual")).alias("cells"),
    )
    alone = _settled(open_cells.where("alone")).unionByName(_settled(clusters.where("n = 1")))
    several = clusters.where("n > 1").select(*KEYS, "cells").mapInPandas(_matched(tolerance), _LEFT)
    left = alone.unionByName(several).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("missed", "added", "renamed")])
    pairs = F.least("missed", "added")
    counted = left.select(
        *KEYS,
        (F.col("missed") - pairs).alias("missing"),
        (F.col("added") - pairs).alias("extra"),
        pairs.alias("amount"),
        F.col("renamed").alias("merchant"),
    )
    return counted.where(reduce(lambda a, b: a | b, [F.col(p) > 0 for p in PROBLEMS]))


def parity_differences(expected: DataFrame, actual: DataFrame, tolerance: Decimal = CENT) -> DataFrame:
    """One row (key, problem) per row that is missing, extra, or differs by more than allowed."""
    kinds: list[Column] = [F.struct(F.lit(p).alias("problem"), F.col(p).alias("n")) for p in PROBLEMS]
    each = parity_counts(expected, actual, tolerance).select(*KEYS, F.inline(F.array(*kinds))).where("n > 0")
    return each.select(*KEYS, "problem", F.explode(F.sequence(F.lit(1), "n"))).drop("col")

"""Rows of repeated keys are matched, not compared by rank."""

import random
from collections import Counter
from decimal import Decimal

import pytest

from cashweave.plans import parity, quality
from small import D, local, rows

MART = (
    "sku_id string, account_number string, merchant string, amount_pulled decimal(18,2), "
    "amount_received decimal(18,2), sales_proceeds decimal(18,2)"
)


def _mart(spark, entries):
    """Rows (sku, account, merchant, pulled[, received, sales])."""
    return local(spark, [(*e[:3], *[D(str(x)) for x in e[3:]], *[Decimal(0)] * (6 - len(e))) for e in entries], MART)


def _problems(spark, expected, actual):
    found = parity.parity_differences(_mart(spark, expected), _mart(spark, actual))
    return Counter(r["problem"] for r in found.collect())


def test_a_missing_row_leaves_the_others_alone(spark):
    three = [("A", "V", "M", n) for n in (1, 2, 3)]
    assert _problems(spark, three, three[1:]) == {"missing": 1}
    assert _problems(spark, three[1:], three) == {"extra": 1}
    assert _problems(spark, three, [three[0], ("A", "V", "M", 9), three[2]]) == {"amount": 1}
    assert _problems(spark, three, [("A", "V", "N", 1), *three[1:]]) == {"merchant": 1}


def test_rows_a_cent_apart_are_matched_in_order(spark):
    """1.00 and 1.01 against 1.01 and 1.02: the equal ones must not take each other."""
    assert _problems(spark, [("A", None, "M", 1), ("A", None, "M", 1.01)], [("A", None, "M", 1.01), ("A", None, "M", 1.02)]) == {}
    assert _problems(spark, [("A", None, "M", 1), ("A", None, "M", 1.01)], [("A", None, "M", 1.02), ("A", None, "M", 1.03)]) == {"amount": 1}
    assert _problems(spark, [(None, None, None, 5, 1, 1)] * 3, [(None, None, None, 5, 1.01, 0.99)] * 2) == {"missing": 1}


def test_random_removals(spark):
    """However rows repeat, what is removed is missing, and nothing else."""
    dice = random.Random(4)
    base = [(f"S{dice.randint(0, 20)}", dice.choice(["V", None]), dice.choice("MN"), dice.randint(0, 400) / 100, dice.randint(0, 3), 1) for _ in range(800)]
    kept = [r for r in base if dice.random() > 0.2]
    found = parity.parity_differences(_mart(spark, base), _mart(spark, kept))
    gone = Counter((s, a) for s, a, *_ in base) - Counter((s, a) for s, a, *_ in kept)
    # Rows of other merchants within a cent may stand in for each other: their key says so.
    problems = Counter(tuple(r) for r in found.collect())
    assert Counter({k[:2]: n for k, n in problems.items() if k[2] == "missing"}) == gone
    assert all(k[2] in ("missing", "merchant") for k in problems)


def _most(expected, actual):
    """The size of a largest matching of amounts within a cent, by augmenting paths."""
    near = [[j for j, a in enumerate(actual) if abs(a - e) <= 1] for e in expected]
    taken = {}

    def place(i, seen):
        for j in near[i]:
            if j not in seen:
                seen.add(j)
                if j not in taken or place(taken[j], seen):
                    taken[j] = i
                    return True
        return False

    return sum(place(i, set()) for i in range(len(expected)))


@pytest.mark.parametrize("seed", range(3))
def test_no_matching_is_larger(spark, seed):
    dice = random.Random(seed)
    expected, actual, wanted = [], [], {}
    for key in range(60):
        e, a = ([dice.randint(0, 14) for _ in range(dice.randint(0, 9))] for _ in "ea")
        expected += [(f"K{key}", "V", "M", 3, n / 100) for n in e]
        actual += [(f"K{key}", "V", "M", 3, n / 100) for n in a]
        m = _most(e, a)
        wanted[f"K{key}"] = (max(len(e) - len(a), 0), max(len(a) - len(e), 0), min(len(e), len(a)) - m)
    found = {r["sku_id"]: (r["missing"], r["extra"], r["amount"]) for r in parity.parity_counts(_mart(spark, expected), _mart(spark, actual)).collect()}
    assert found == {k: v for k, v in wanted.items() if any(v)}


def test_many_repeats_cost_nothing(spark):
    """A key with a million equal rows is one cell."""
    many = spark.range(1_000_000).selectExpr("'A' AS sku_id", "cast(null AS string) AS account_number", "'M' AS merchant", "1.00 AS amount_pulled", "cast(null AS decimal(18,2)) AS amount_received", "id % 2 AS sales_proceeds")
    less = many.where("id % 1000 <> 7")
    found = parity.parity_counts(many, less).collect()
    assert [tuple(r)[2:] for r in found] == [(1000, 0, 0, 0)]
    check = quality.check_parity(many, less).first()
    assert (check["passed"], check["detail"]) == (False, "missing=1000 extra=0 amount=0 merchant=0")
    assert rows(parity.parity_differences(many, many)) == []


def test_only_cells_near_others_are_clustered(spark, monkeypatch):
    """Cells far from all others of their key are settled by their counts, without a list."""
    clustered = []
    plain = parity._clusters
    monkeypatch.setattr(parity, "_clusters", lambda c, t: clustered.append(c.count()) or plain(c, t))
    many = [("A", None, "M", n) for n in (0, 1, 2, 3, 3.01)]
    few = [("A", None, "M", n) for n in (1, 3.02)]
    found = parity.parity_counts(_mart(spark, many), _mart(spark, few))
    assert rows(found) == [("A", None, 3, 0, 0, 0)]
    assert clustered == [3]

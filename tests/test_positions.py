import random

import pytest

from cashweave.operators.positions import with_positions
from small import local


@pytest.mark.parametrize("rows_per_part", [7, 100, 10_000])
def test_positions_are_those_of_a_sort(spark, rows_per_part):
    """Ties, missing values and keys with most of the rows; one part and many."""
    dice = random.Random(rows_per_part)
    rows = [(dice.choice([None, "a", "b", "b", "b", "c", ""]), dice.choice([None, 1, 2, 3]), i) for i in range(300)]
    found = with_positions(local(spark, rows, "k string, n int, id long").repartition(5), ["k", "n", "id"], "place", rows_per_part).collect()
    wanted = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2]))
    assert [tuple(r)[1:] for r in sorted(found, key=lambda r: r["place"])] == wanted
    assert sorted(r["place"] for r in found) == list(range(1, 301))


def test_no_rows(spark):
    assert with_positions(local(spark, [], "k string"), ["k"]).collect() == []

"""Every order played document by document, against the counts of coalitions."""

from itertools import permutations

import pytest
from brute import words

from cashweave.llm import interaction
from cashweave.llm.interaction import audit, failures


def _fails(rows):
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = words(t)
        upper = sum("A" <= c <= "Z" for c in t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows)
        out.append({n for n, f in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * upper > 10 * len(t), any(c in "#$%&*|" for c in t), copy), strict=True) if f})
    return out


def _played(rows, labels):
    fails, out, total = _fails(rows), {}, {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    for part in {r[2] or "" for r in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                earlier = [k for k in own if k not in left and f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                total[part, f] = total.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(earlier), sum(fails[k] == {f} for k in own), sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_odd_rows_equal_play(spark, odd):
    labels = [(1, 1, 0), (5, 1, 1), (6, 0, 1), (6, 1, None), (8, None, 1), (None, 1, 1), (77, 1, 1), (9, 1, 0)]
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang").collect()]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit(failures(odd, frame), "ABCDE").collect()
    assert len(found) == len({r[2] for r in rows}) * 600
    assert {tuple(r) for r in found} == _played(rows, labels)


def test_empty(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(failures(none, labels), "ABCDE").collect() == []


@pytest.mark.parametrize("filters", ["A", "XY", "PQRS"])
def test_any_number_of_filters(spark, filters):
    """Shapley values are what is removed over all orders; they add up to all that goes, n! times."""
    from math import factorial

    rows = [(str(k % 2), *[bool(k >> i & 1) for i in range(len(filters))], False, False) for k in range(1 << len(filters)) for _ in range(k + 1)]
    frame = spark.createDataFrame(rows, ", ".join(["part string", *[f"{f} boolean" for f in filters], "good boolean", "toxic boolean"]))
    found = audit(frame, filters).collect()
    for part in {r["part"] for r in found}:
        shares = {}
        for f in filters:
            own = [r for r in found if r["part"] == part and r["filter_order"][r["step"] - 1] == f]
            assert len({r["shapley"] for r in own}) == 1
            shares[f] = own[0]["shapley"]
            assert shares[f] == sum(r["removed"] for r in own)
        gone = sum(r[0] == part and any(r[1:-2]) for r in rows)
        assert sum(shares.values()) == factorial(len(filters)) * gone


def test_too_many_filters(spark):
    with pytest.raises(ValueError, match="filters"):
        audit(spark.range(1), "ABCDEFG")


def test_query_is_registered():
    from cashweave.llm import queries

    assert queries.QUERIES["op13_filter_audit"] is interaction.op13_filter_audit

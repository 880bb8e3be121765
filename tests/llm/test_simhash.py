import numpy as np
import pytest
from brute import components, fingerprint

from cashweave.llm import simhash


def _expected(rows):
    prints = [fingerprint(t) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = components(rows, links)
    least = {}
    for (i, *_), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{p:016x}", least.get(r)) for (i, *_), p, r in zip(rows, prints, roots, strict=True)), key=str)


def _found(df):
    from pyspark.sql import functions as F

    done = simhash.near_duplicates(df).select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("f"), "component_id")
    return sorted((tuple(r) for r in done.collect()), key=str)


def test_odd_rows_equal_brute_force(odd):
    assert _found(odd) == _expected([tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_small_table_equals_brute_force(small):
    assert _found(small) == _expected([tuple(r) for r in small.select("doc_id", "text").collect()])


def test_empty(none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.least_of_groups(none, keep=("text",)).collect() == []


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_no_link_is_lost(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64).astype(np.uint64)
    prints = [int(b) for b in base]
    for b in base:  # chains and near misses
        for _ in range(6):
            x = int(b)
            for p in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(p)
            prints.append(x)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fingerprint long"), bits)
    place = {s[0]: n for n, s in enumerate(signed)}
    got = components(prints, [(place[r["a"]], place[r["b"]]) for r in links.collect()])
    want = components(prints, [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits])
    assert got == want


@pytest.mark.parametrize("n", [40, 5000])
def test_long_posting_lists(n):
    """Thousands of values in one list: pairwise and by flipped bits, with the same components."""
    rng = np.random.default_rng(n)
    prints = np.unique(rng.integers(0, 1 << 24, n).astype(np.uint64)) | np.uint64(1 << 63)
    zero = np.zeros(len(prints), np.int64)
    mask = ~((1 << 24) - 1) & (1 << 64) - 1
    a, b = simhash._stars(zero, zero, prints, [mask], 2)
    place = {int(p): i for i, p in enumerate(prints)}
    got = components(prints, [(place[int(x)], place[int(y)]) for x, y in zip(a, b, strict=True)])
    near = [(i, int(j)) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 2)]
    assert got == components(prints, near)


def test_lists_over_many_batches():
    """A list that begins in one batch and ends three batches later is seen whole."""
    import pyarrow as pa

    rows = [(0, 1, 7), *((0, 2, 8 + (i << 20)) for i in range(25)), (0, 2, 9), (1, 2, 5)]
    batches = [pa.RecordBatch.from_pydict({"c": [r[0] for r in rows[i : i + 5]], "k": [r[1] for r in rows[i : i + 5]], "p": [r[2] for r in rows[i : i + 5]]}) for i in range(0, len(rows), 5)]
    out = [tuple(r.values()) for b in simhash._search([0], 1)(iter(batches)) for r in b.to_pylist()]
    assert {8, 9} <= {x for pair in out for x in pair}
    assert 7 not in {x for pair in out for x in pair}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r["node"]: r["root"] for r in simhash.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_one_row_of_each_group(odd, small):
    """The least id of each group, null ids last; repeated rows and rows of one id with other texts too."""
    for df in (odd, small):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        prints = [fingerprint(t) for _, t in rows]
        roots = components(rows, [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
        want = {r: min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if roots[i] == r) for r in set(roots)}
        done = simhash.least_of_groups(df, keep=("text", "lang")).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in done) == sorted(want.values())
        assert all((r["doc_id"], r["text"]) in rows for r in done)


def test_groups_grow_without_pairs(spark):
    """A family of edited copies that are near each other: one row stays, whatever its size."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(400)]
    for n in (200, 400):
        rows = []
        for copy in range(n):
            own = list(base)
            own[int(rng.integers(400))] = f"e{copy}"
            rows.append((n - copy, " ".join(own)))
        rows.append((10_000, "another text that has nothing to do with the others here"))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        prints = {i: fingerprint(t) for i, t in rows}
        ids = sorted(prints)
        roots = components(ids, [(a, b) for a in range(len(ids)) for b in range(a) if (prints[ids[a]] ^ prints[ids[b]]).bit_count() <= 3])
        assert {r["doc_id"] for r in simhash.least_of_groups(docs, keep=("text",)).collect()} == {ids[r] for r in set(roots)}

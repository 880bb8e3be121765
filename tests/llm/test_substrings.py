import hashlib

import pytest
from brute import removed

from cashweave.llm import substrings


def _expected(rows, k=13):
    out = []
    for i, w, cut in removed(rows, k):
        kept = " ".join(x for p, x in enumerate(w) if p not in cut)
        out.append((i, len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def _found(df, k=13):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in substrings.dedup_substrings(df, k).collect()), key=str)


def test_odd_rows(odd):
    assert _found(odd) == _expected([tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_ids_that_repeat_with_other_texts(spark):
    a, b = " ".join(f"w{i}" for i in range(20)), " ".join(f"v{i}" for i in range(30))
    rows = [(3, a), (3, b), (1, b[:60]), (2, b), (-5, a[5:]), (9, a + " " + b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(df, 4) == _expected(rows, 4)


@pytest.mark.parametrize("batch", [1, 500])
def test_small_table_in_small_batches(small, monkeypatch, batch):
    """What a batch decides by itself and what buckets decide is the same."""
    monkeypatch.setattr(substrings, "BATCH_WINDOWS", batch * 1000)
    assert _found(small) == _expected([tuple(r) for r in small.select("doc_id", "text").collect()])


def test_layout_is_kept(spark):
    text = "one two\n\nthree  four five\nsix seven"
    rows = [(1, "three four five six"), (2, text)]
    done = {r["doc_id"]: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), 4, layout=True).collect()}
    assert done[2]["kept_text"] == "one two\n\nseven"
    assert [tuple(x) for x in done[2]["removed"]] == [(2, 6)]
    assert done[1]["kept_text"] == rows[0][1]


def test_empty(none):
    assert substrings.dedup_substrings(none).collect() == []


def test_memory_of_a_bucket():
    """A bucket's windows are unpacked once, and sorted in under 58 bytes each."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n, dice, packed = 20_000, np.random.default_rng(1), []
    for _ in range(10):
        docs, twins, places = np.sort(dice.integers(0, 1 << 30, n)), np.zeros(n, np.int32), dice.integers(0, 1000, n).astype(np.int32)
        packed += substrings._rows(np.zeros(n, np.int64), 1, substrings._PACKED_SCHEMA, docs, twins, places, dice.integers(0, 160_000, n).astype(np.uint64))
    rows, judge = pa.Table.from_batches(packed), substrings._judge(64)
    judge((pa.scalar(0),), rows)
    tracemalloc.start()
    try:
        judge((pa.scalar(0),), rows)
        assert tracemalloc.get_traced_memory()[1] < 58 * 10 * n
    finally:
        tracemalloc.stop()

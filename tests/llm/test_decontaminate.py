import random

import pytest

from cashweave.llm import decontaminate


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert decontaminate.common(a, b) == _lcs(a, b)


@pytest.mark.parametrize("rank", [decontaminate.RANK, 60])
def test_planted_leaks(spark, rank):
    """Whole items, items with words left out or changed, and none in texts of the same words."""
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "btkmnr" for b in "aeiou" for c in ("n", "st", "l", "rr", "x")] + ["the", "of", "and"] * 20
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    items = [(i, sentence(18) + " " + sentence(8)) for i in range(60)]
    docs, want = [], set()
    for d in range(240):
        body = [sentence(rng.randint(5, 20)) for _ in range(rng.randint(1, 30))]
        if d % 4 == 0:
            i, text = items[d // 4]
            words = text.split()
            if d % 8 == 0:
                words = [w for k, w in enumerate(words) if k % 8 != 3]
            body.insert(rng.randint(0, len(body)), " ".join(words) if d % 12 else " ".join(words).upper())
            want.add((d, i))
        docs.append((d, " ".join(body)))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), rank)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got <= want
    assert len(got) >= (0.97 if rank > 60 else 0.85) * len(want)


def test_benchmark_in_blocks(spark, small, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {tuple(r)[:2] for r in decontaminate.leaks(small, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    assert {tuple(r)[:2] for r in decontaminate.leaks(small, items).collect()} == whole and whole


def test_odd_rows_and_empty(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, odd.where("doc_id = 6").first()["text"]), (4, "another text under the same id with quite enough words in it")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(odd, items).collect())
    assert got == [(5, 4), (6, 4)]
    assert decontaminate.leaks(none, items).collect() == []
    assert decontaminate.leaks(odd, items.limit(0)).collect() == []


def _random_items(rng, number, low=15, high=59):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 4)))
    vocabulary = [word() for _ in range(4000)]
    common = vocabulary[:40]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    return text, [(i, text(rng.randint(low, high))) for i in range(number)]


@pytest.mark.parametrize("number", [1000, 3000])
def test_large_benchmarks_lose_nothing(spark, number):
    """Verbatim and edited items (one word in five changed) of large benchmarks are all found."""
    rng = random.Random(number)
    text, items = _random_items(rng, number)
    docs, want = [], set()
    for d in range(300):
        i, words = items[rng.randrange(number)]
        if d % 2:
            words = [w if k % 5 else "changed" + w for k, w in enumerate(words, 1)]
        docs.append((d, " ".join(text(rng.randint(0, 200)) + words + text(rng.randint(0, 200)))))
        want.add((d, i))
    listed = [(i, " ".join(w)) for i, w in items]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(listed, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not want - got


def test_every_leak_that_the_check_accepts_is_found(spark):
    """Items of all lengths of which just enough is left: 0.75 of the words, or 0.6 with the answer."""
    rng = random.Random(5)
    text, items = _random_items(rng, 200, 8, 120)
    items = [(i, " ".join(w[: len(w) * 2 // 3]) + ". " + " ".join(w[len(w) * 2 // 3 :])) for i, w in items]
    docs, want = [], set()
    for i, raw in items:
        item = decontaminate.as_item(i, raw)
        n, k = len(item.words), len(item.words) - len(item.answer)
        if i % 2:  # the answer whole, and of the rest as few words as will do
            kept = set(rng.sample(range(k), max(0, -(-6 * n // 10) - len(item.answer)))) | set(range(k, n))
        else:
            kept = set(rng.sample(range(n), -(-3 * n // 4)))
        words = [w.decode() if p in kept else "changed" for p, w in enumerate(item.words)]
        assert decontaminate.judge(item, [w.encode() for w in words])[2]
        docs.append((i, " ".join(text(rng.randint(0, 200)) + words + text(rng.randint(0, 200)))))
        want.add((i, i))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not want - got

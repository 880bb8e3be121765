"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words. A word is a cell of a hashed vocabulary (in lower
case) with its inverse document frequency over all passages of the corpus. The latent
space comes from a randomised SVD, in Spark tasks, of the TF-IDF passages of the
benchmark (frequencies are those of the corpus): tasks multiply their passages with a random matrix made from the cells' hashes, the
driver sees two small sums (its rank squared, and rank by benchmark cells). Every
passage of the corpus is folded into that space and compared with all benchmark
passages by cosine. Candidates are checked by the longest common subsequence of words,
and by whether the item's answer (its last sentence) is there too, so that paraphrases
count which keep most words in order.

Retrieval by cosine can miss a leak: a short item in a long window, an item whose rare
words the basis spans badly. So texts are searched in a second way that follows from the
check itself. A leak has `need` of the item's n words, so of its n - need + RARE rarest
words it has RARE at least, within a stretch of twice the item. Every such place is
checked; no leak within one and a half times the item's length is lost, whatever the
size of the benchmark.

Before folding in, a passage is tested by a bound: its cosine with anything cannot
exceed the share of its norm that lies in cells of the benchmark. Most passages end
there, without error.

The corpus is read twice and never shuffled: what moves are tables of frequencies (one
of fixed size for a task) and the candidates. A pass takes some
`BLOCK_ITEMS` items, so a larger benchmark costs further passes and no more memory. A
pass searches blocks of some BLOCK_PASSAGES passages, each with a basis of its own.

Defined cases: a null or empty text, or item, is never a leak; an item of fewer than
LEAST_WORDS words is not searched for; rows with null ids are judged like others;
repeated rows give repeated pairs once; an empty table on either side gives an empty
result; only doc_id and text, item_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import planes, slices, table, unnamed, unplanes
from cashweave.llm.tokens import mix, spans, word_hashes

CELLS = 1 << 18
RANGES = 16
WINDOW, STRIDE = 32, 16
ITEM_WINDOW, ITEM_STRIDE = 64, 32
RANK, SPARE, ENERGY = 256, 16, 0.95
#: Items of a pass over the corpus. Its blocks have so few passages that the sketch covers their whole range.
BLOCK_ITEMS = 1000
BLOCK_PASSAGES = 192
#: Words of an item's rarest that must be near each other in a text, beyond those that a leak may lack.
RARE = 3
#: A block is small: few tasks multiply it, so that few partial sums of rank by rank meet.
ITEM_TASKS = 4
LEAST_WORDS = 8
COSINE = 0.5
#: Least share of an item's words found in order: alone, and with its answer there.
VERBATIM, WITH_ANSWER, ANSWER = 0.75, 0.6, 0.8


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def _cells(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = spans(data, at)
    return (word_hashes(data, starts, ends, lower=True) % np.uint64(CELLS)).astype(np.int64), first


def window_starts(first: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of all windows: every `stride` words until one reaches the text's end."""
    counts = np.diff(first)
    steps = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - window) // stride)), 0)
    text = np.repeat(np.arange(len(counts)), steps)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(steps) - steps, steps)
    start = first[text] + nth * stride
    return text, start, np.minimum(start + window, first[text + 1])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages with each cell, and their number in cell -1; passages do not overlap here."""
    total, passages = np.zeros(CELLS, np.int64), 0
    for batch in batches:
        for _, _, data, at in slices(batch.column(0)):
            cells, first = _cells(data, at)
            _, start, end = window_starts(first, WINDOW, WINDOW)
            owner = np.searchsorted(start, np.arange(len(cells)), "right") - 1
            total += np.bincount(np.unique(owner * CELLS + cells) % CELLS, minlength=CELLS)
            passages += len(start)
    step = CELLS // RANGES
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *range(RANGES)], pa.int32()), pa.array([planes(np.array([passages]), 6), *(planes(total[i * step : (i + 1) * step], 6) for i in range(RANGES))], pa.binary())],
        names=["part", "counts"],
    )


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    total: np.ndarray | int = 0
    for raw in rows.column("counts"):
        total = total + unplanes(raw.as_py(), 6)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([planes(total, 6)], pa.binary())], names=["part", "counts"])


def weights(docs: DataFrame) -> np.ndarray:
    """Inverse passage frequency of every cell, over all texts of docs."""
    out, passages = np.zeros(CELLS), 0
    rows = unnamed(docs, "text").mapInArrow(_frequencies, "part int, counts binary").groupBy("part").applyInArrow(_added, "part int, counts binary")
    for row in rows.collect():  # RANGES + 1 rows
        if row["part"] < 0:
            passages = int(unplanes(bytes(row["counts"]), 6)[0])
        else:
            out[row["part"] * (CELLS // RANGES) :][: CELLS // RANGES] = unplanes(bytes(row["counts"]), 6)
    return np.log((1 + passages) / (1 + out)).astype(np.float32) + np.float32(0.1)


def _random(cells: np.ndarray, width: int) -> np.ndarray:
    """Rows of the random matrix (plus and minus one) for cells, from their hashes alone."""
    key = mix(cells.astype(np.uint64)[:, None] * np.uint64(4096) + np.arange(width, dtype=np.uint64)[None, :] + np.uint64(1))
    return np.where(key >> np.uint64(63), 1.0, -1.0)


def _rows_of(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, cells, unit TF-IDF values) of every passage of items; columns item_id, text."""
    for batch in batches:
        for lo, _, data, at in slices(batch.column(1)):
            cells, first = _cells(data, at)
            text, start, end = window_starts(first, ITEM_WINDOW, ITEM_STRIDE)
            for t, a, b in zip(text.tolist(), start.tolist(), end.tolist(), strict=True):
                own, tf = np.unique(cells[a:b], return_counts=True)
                value = tf * idf[own]
                yield batch.column(0)[lo + t].as_py(), own, value / np.linalg.norm(value)


def _added_values(key: tuple, rows: pa.Table) -> pa.Table:
    total: np.ndarray | float = 0.0
    for raw in rows.column("v"):
        total = total + np.frombuffer(raw.as_py(), np.float64)
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["k", "v"])


def latent_basis(items: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(cells of the items, basis: cells by directions), by randomised SVD of the items' passages."""
    width = rank + SPARE

    def gram(batches):
        total = np.zeros((width, width))
        for _, cells, value in _rows_of(batches, idf):
            y = value @ _random(cells, width)
            total += np.outer(y, y)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["k", "v"])

    summed = items.mapInArrow(gram, "k long, v binary").groupBy("k").applyInArrow(_added_values, "k long, v binary").collect()
    if not summed:
        return np.zeros(0, np.int64), np.zeros((0, 1), np.float32)
    size, vectors = np.linalg.eigh(np.frombuffer(bytes(summed[0]["v"])).reshape(width, width))
    use = size > max(size.max(), 0) * 1e-9
    # Passages times this are orthonormal columns: the range of the passage matrix.
    ortho = vectors[:, use] / np.sqrt(size[use]) if use.any() else np.zeros((width, 1))

    def project(batches):
        total: dict[int, np.ndarray] = {}
        for _, cells, value in _rows_of(batches, idf):
            q = (value @ _random(cells, width)) @ ortho
            for c, v in zip(cells.tolist(), value.tolist(), strict=True):
                total[c] = total[c] + q * v if c in total else q * v
        for c, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([v.tobytes()], pa.binary())], names=["k", "v"])

    rows = items.mapInArrow(project, "k long, v binary").groupBy("k").applyInArrow(_added_values, "k long, v binary").collect()
    cells = np.array([r["k"] for r in rows], np.int64)
    small = np.array([np.frombuffer(bytes(r["v"])) for r in rows]).T  # directions by cells
    if not len(cells):
        return cells, np.zeros((0, 1), np.float32)
    left, singular, right = np.linalg.svd(small, full_matrices=False)
    share = np.cumsum(singular**2) / (singular**2).sum()
    k = min(rank, int(np.searchsorted(share, ENERGY)) + 1)
    order = np.argsort(cells)
    return cells[order], right[:k].T[order].astype(np.float32)


def common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & masks.get(w, 0)
        row = (row + hit | row & ~hit) & full
    return len(a) - row.bit_count()


@dataclass(frozen=True)
class Item:
    item_id: int
    words: list[bytes]
    answer: list[bytes]


def as_item(item_id: int, text: str) -> Item:
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
    return Item(item_id, words_of(text), words_of(sentences[-1]) if len(sentences) > 1 else [])


def judge(item: Item, near: list[bytes]) -> tuple[float, bool, bool]:
    """(share of the item in order, is its answer there, is it a leak)."""
    share = common(item.words, near) / len(item.words)
    answer = bool(item.answer) and common(item.answer, near) >= ANSWER * len(item.answer)
    return share, answer, share >= VERBATIM or (share >= WITH_ANSWER and answer)


def _stride_sums(row: np.ndarray, first: np.ndarray, where: np.ndarray, wanted: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Latent sums over stretches of STRIDE words, of those wanted; where[d] is text d's first stretch."""
    kept = np.flatnonzero(row >= 0)
    owner = np.searchsorted(first, kept, "right") - 1
    stretch = where[owner] + (kept - first[owner]) // STRIDE
    use = wanted[stretch]
    kept, stretch = kept[use], stretch[use]
    sums = np.zeros((where[-1] + WINDOW // STRIDE, scaled.shape[1]), np.float32)
    if len(kept):
        begins = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
        sums[stretch[begins]] = np.add.reduceat(scaled[row[kept]], begins, axis=0)
    return sums


def _candidates(own: np.ndarray, first: np.ndarray, row_of: np.ndarray, scaled: np.ndarray, latent: np.ndarray, idf: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, passage of the benchmark, first word, end, cosine) of windows near enough, in order."""
    text, start, end = window_starts(first, WINDOW, STRIDE)
    weight, row = idf[own].astype(np.float64) ** 2, row_of[own]
    norm, inside = (np.concatenate([[0.0], np.cumsum(w)]) for w in (weight, np.where(row >= 0, weight, 0.0)))
    norm, inside = norm[end] - norm[start], inside[end] - inside[start]
    near = np.flatnonzero(inside >= COSINE * COSINE * norm)
    if not len(near):
        return
    where = np.concatenate([[0], np.cumsum(-(-np.diff(first) // STRIDE))])
    limit = where[text[near] + 1]
    at = where[text[near]] + (start[near] - first[text[near]]) // STRIDE
    wanted = np.zeros(where[-1] + WINDOW // STRIDE, bool)
    for k in range(WINDOW // STRIDE):
        wanted[at + k] = True
    sums = _stride_sums(row, first, where, wanted, scaled)
    for lo in range(0, len(near), 4096):
        part = slice(lo, lo + 4096)
        vectors = np.zeros((len(near[part]), scaled.shape[1]), np.float32)
        for k in range(WINDOW // STRIDE):
            vectors += np.where((at[part] + k < limit[part])[:, None], sums[at[part] + k], 0)
        cosines = vectors @ latent.T / np.sqrt(norm[near[part]])[:, None]
        for w, i in zip(*np.nonzero(cosines >= COSINE), strict=True):
            n = near[lo + w]
            yield int(text[n]), int(i), int(start[n]), int(end[n]), float(cosines[w, i])


@dataclass(frozen=True)
class Block:
    """Items of one basis. latent: unit rows of their passages; owners: the items' places."""

    items: list[Item]
    cells: np.ndarray
    basis: np.ndarray
    owners: np.ndarray
    latent: np.ndarray


@dataclass(frozen=True)
class Rare:
    """The rarest words of all items: by cell, the items (places in `items`) that have it among them."""

    row_of: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    needed: np.ndarray
    reach: np.ndarray


def rarest(items: list[Item], idf: np.ndarray) -> Rare:
    pairs, needed = [], []
    for n, item in enumerate(items):
        data = b" ".join(item.words)
        own, _ = _cells(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        need = int(np.ceil((WITH_ANSWER if item.answer else VERBATIM) * len(own) - 1e-9))
        least = min(RARE, need)
        few = np.unique(own[np.argsort(-idf[own], kind="stable")[: len(own) - need + least]])
        pairs.append(np.stack([few, np.full(len(few), n)]))
        needed.append(least)
    cells, owners = np.concatenate(pairs, axis=1)
    order = np.argsort(cells, kind="stable")
    known, first = np.unique(cells[order], return_index=True)
    row_of = np.full(CELLS, -1, np.int32)
    row_of[known] = np.arange(len(known))
    return Rare(row_of, np.append(first, len(order)), owners[order], np.array(needed), np.array([max(2 * len(i.words), 16) for i in items]))


def _rare_places(own: np.ndarray, first: np.ndarray, rare: Rare) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first word, end) of places with enough of an item's rarest words, in order."""
    row = rare.row_of[own]
    at = np.flatnonzero(row >= 0)
    times = rare.first[row[at] + 1] - rare.first[row[at]]
    word = np.repeat(at, times)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(times) - times, times)
    item = rare.owners[rare.first[row[word]] + nth]
    text = np.searchsorted(first, word, "right") - 1
    order = np.lexsort((word, item, text))
    word, item, text = word[order], item[order], text[order]
    last = np.arange(len(word)) + rare.needed[item] - 1
    inside = np.minimum(last, max(0, len(word) - 1))
    near = np.flatnonzero((last < len(word)) & (text[inside] == text) & (item[inside] == item) & (word[inside] - word < rare.reach[item]))
    held: list[int] = []
    for t, i, begin, end in zip(text[near].tolist(), item[near].tolist(), word[near].tolist(), (word[inside[near]] + 1).tolist(), strict=True):
        # A leak may go on to both sides of these words. Overlapping places are one.
        wide = int(rare.reach[i]) // 2
        begin, end = max(begin - wide, int(first[t])), min(end + wide, int(first[t + 1]))
        if held and held[:2] == [t, i] and begin <= held[3]:
            held[3] = end
            continue
        if held:
            yield tuple(held)
        held = [t, i, begin, end]
    if held:
        yield tuple(held)


def _search(blocks: list[Block], idf: np.ndarray):
    """Leaks of texts (doc_id, text)."""
    rows, scaled = [], []
    for block in blocks:
        row_of = np.full(CELLS, -1, np.int32)
        row_of[block.cells] = np.arange(len(block.cells))
        rows.append(row_of)
        scaled.append(block.basis * idf[block.cells][:, None])
    items = [i for block in blocks for i in block.items]
    base = np.cumsum([0, *(len(block.items) for block in blocks)])
    rare = rarest(items, idf)

    def cosine_of(own: np.ndarray, i: int) -> float:
        """The best cosine of a place with the item's passages."""
        b = int(np.searchsorted(base, i, "right")) - 1
        row = rows[b][own]
        mine = blocks[b].latent[blocks[b].owners == i - base[b]]
        if not len(mine):
            return 0.0
        norm = np.sqrt((idf[own].astype(np.float64) ** 2).sum())
        return float((mine @ scaled[b][row[row >= 0]].sum(axis=0)).max() / norm)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for lo, _, data, at in slices(batch.column(1)):
                own, first = _cells(data, at)
                if not len(own):
                    continue
                split = _Words(data, at)
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for n, block in enumerate(blocks):
                    for t, i, begin, stop, cosine in _candidates(own, first, rows[n], scaled[n], block.latent, idf):
                        key = t, int(base[n] + block.owners[i])
                        if key in best:  # overlapping windows of one passage are judged together
                            high, b, e = best[key]
                            if begin <= e:
                                best[key] = max(high, cosine), b, max(e, stop)
                                continue
                            found += _verdict(batch, lo, key, best[key], split, first, items)
                        best[key] = cosine, begin, stop
                for key, value in best.items():
                    found += _verdict(batch, lo, key, value, split, first, items)
                for t, i, begin, stop in _rare_places(own, first, rare):
                    for doc, item, _, *rest in _verdict(batch, lo, (t, i), (0.0, begin, stop), split, first, items):
                        found.append((doc, item, cosine_of(own[begin:stop], i), *rest))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()))], names=["doc_id", "item_id", "cosine", "in_order", "answer"])

    return search


class _Words:
    """The words of a slice's texts; the text asked for last is kept."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.text, self.words = data, at, -1, []

    def of(self, t: int) -> list[bytes]:
        if t != self.text:
            self.text, self.words = t, self.data[self.at[t] : self.at[t + 1]].tobytes().split()
        return self.words


def _verdict(batch, lo, key, value, split, first, items) -> list[tuple]:
    """The pair as a row if it is a leak. Words around the passage are looked at too."""
    (t, i), (cosine, begin, end) = key, value
    item = items[i]
    margin = len(item.words)
    words = split.of(t)
    near = words[max(0, begin - first[t] - margin) : end - first[t] + margin]
    there = set(near)
    # The words there at all bound those there in order.
    if sum(w in there for w in item.words) < WITH_ANSWER * len(item.words):
        return []
    # Judged over stretches of twice the item, so that chance matches of a long passage do not add up.
    stretch = max(2 * len(item.words), 16)
    best = max((judge(item, near[k : k + stretch]) for k in range(0, max(1, len(near) - len(item.words)), max(1, len(item.words) // 2))), default=(0.0, False, False), key=lambda j: (j[2], j[0]))
    return [(batch.column(0)[lo + t].as_py(), item.item_id, cosine, best[0], best[1])] if best[2] else []


def _block(mine: DataFrame, idf: np.ndarray, rank: int) -> Block | None:
    """A block of the items (item_id, text) of mine; None without any to search for."""
    mine = mine.coalesce(ITEM_TASKS)
    rows = mine.orderBy("item_id", "text").collect()  # a block's worth
    items = [i for i in (as_item(r["item_id"], r["text"]) for r in rows) if len(i.words) >= LEAST_WORDS]
    if not items:
        return None
    cells, basis = latent_basis(mine.where(F.size(F.split(F.trim("text"), r"\s+")) >= LEAST_WORDS), idf, rank)
    place = {c: n for n, c in enumerate(cells.tolist())}
    latent, owners = [], []
    for n, item in enumerate(items):
        data, at = np.frombuffer(b" ".join(item.words), np.uint8), np.array([0, len(b" ".join(item.words))])
        own, first = _cells(data, at)
        _, start, end = window_starts(first, ITEM_WINDOW, ITEM_STRIDE)
        for a, b in zip(start.tolist(), end.tolist(), strict=True):
            rows_ = [place[c] for c in own[a:b].tolist() if c in place]
            vector = (basis[rows_] * idf[cells[rows_]][:, None]).sum(axis=0)
            size = np.linalg.norm(vector)
            if size > 0:
                latent.append(vector / size)
                owners.append(n)
    return Block(items, cells, basis, np.array(owners, np.int64), np.array(latent, np.float32).reshape(len(latent), basis.shape[1]))


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """(doc_id, item_id, cosine, in_order, answer) of every text that has an item of the benchmark."""
    schema = "doc_id long, item_id long, cosine double, in_order double, answer boolean"
    source = unnamed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    listed = unnamed(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast("long")).withColumn("text", F.lower("text")).where("text is not null").distinct()
    idf = weights(source)
    words = F.size(F.split(F.trim("text"), r"\s+"))
    passages = F.greatest(F.lit(1), 1 + F.ceil((words - ITEM_WINDOW) / ITEM_STRIDE))
    sized = listed.agg(F.count("*").alias("items"), F.sum(passages).alias("passages")).first()
    passes = max(1, -(-sized["items"] // BLOCK_ITEMS))
    # One block if the sketch covers it; otherwise blocks are smaller, as hashes do not deal evenly.
    each = max(1, -(-(sized["passages"] or 0) // (BLOCK_PASSAGES * passes))) if (sized["passages"] or 0) > RANK else 1
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes * each))
    out = None
    for n in range(passes):
        blocks = [_block(listed.where(place == n * each + k) if passes * each > 1 else listed, idf, rank) for k in range(each)]
        blocks = [b for b in blocks if b is not None]
        if blocks:
            found = source.mapInArrow(_search(blocks, idf), schema)
            out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("in_order").alias("in_order"), F.max("answer").alias("answer"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

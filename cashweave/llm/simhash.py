"""SimHash near-dedup over an inverted index of byte positions with count filtering.

A fingerprint has 64 bits: a bit is 1 if it is set in over half the hashes (XXH64,
seed 42) of the text's word shingles. Two fingerprints that differ in at most d bits
differ in at most d of their 8 bytes, so they share 8 - d bytes at least. The index
therefore has, for every distinct fingerprint, one posting for each choice of 8 - d
byte positions with the bytes there (56 for d = 3): a pair that reaches the
guaranteed number of matches meets in a posting list, and no other pair does. In a
list the shared bytes of each pair are tallied, pairs that reach the number are
retained and verified by their differing bits. With d = 3 a list holds only values
that agree in 40 bits, so it can never have more than 2**24 entries, whatever the
table; lists of over PAIRWISE entries are searched by flipping bits instead of
pairwise. A list returns a spanning star of its links, not all pairs, so results grow
with fingerprints and no link is lost for reachability.

Copies share a fingerprint and enter the index once. Components come from rounds of
large-star and small-star; each round is written to the shared folder.

Defined cases: a null or empty text has fingerprint zero and links like any other; a
text with fewer words than a shingle is one shingle; null ids are allowed (a component
of null ids only has a null component); repeated rows are rows; an empty table gives
an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashweave.llm.base import slices, staged, table, unnamed
from cashweave.llm.tokens import SPACE, spans

SEED = 42
BITS = 3
SMALL = 32
PAIRWISE = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_hashes(data: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles, lower-cased (A-Z) and joined by one space; first[d] as in spans."""
    starts, ends, first = spans(data, at)
    keep = ~SPACE[data]
    inner = np.ones(len(starts), bool)
    inner[first[:-1][first[:-1] < len(starts)]] = False
    keep[starts[inner] - 1] = True
    text = np.where(SPACE[data], np.uint8(0x20), _LOWER[data])[keep].tobytes()
    place = np.concatenate([[0], np.cumsum(keep)])
    begin, end = place[starts], place[ends]
    counts = np.diff(first)
    # The last word of shingle i; texts with fewer words are one shingle of them all.
    owner = np.repeat(np.arange(len(counts)), counts)
    stop = np.minimum(np.arange(len(starts)) + words, first[1:][owner])
    local = np.arange(len(starts)) - first[owner]
    use = np.flatnonzero((local == 0) | (local + words <= counts[owner]))
    hash_of, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((hash_of(text[a:b], seed) for a, b in zip(begin[use].tolist(), end[stop[use] - 1].tolist(), strict=True)), np.uint64, len(use))
    return hashes, np.searchsorted(use, first)


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of hashes the 64 majority bits; an empty run gives zero."""
    counts = np.diff(first)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        begins = first[:-1][full]
        for bit in range(64):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), begins)
            out[full] |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
    return out


def _print_batches(words: int, kept: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(0)):
                fingerprint = majority(*shingle_hashes(data, at, words))
                own = batch.slice(lo, hi - lo)
                names = [*own.schema.names[1 : kept + 1], "fingerprint"]
                yield pa.RecordBatch.from_arrays([*own.columns[1 : kept + 1], pa.array(fingerprint.view(np.int64))], names=names)

    return prints


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep (text may be one), and the fingerprint (as a signed long) of every row."""
    kept = unnamed(docs, "doc_id", *keep).withColumn("doc_id", F.col("doc_id").cast("long"))
    # The text that is read comes first, apart from one that is kept.
    source = docs.select(F.col("text").alias("_read"), F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*kept.schema.fields, T.StructField("fingerprint", T.LongType())])
    return source.mapInArrow(_print_batches(words, len(keep) + 1), schema)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (indices, each at most its own index) after linking a to b."""
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return labels
        a, b = a[open_], b[open_]
        low, high = np.minimum(x[open_], y[open_]), np.maximum(x[open_], y[open_])
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Tally of shared positional bytes, then the differing bits."""
    x = a ^ b
    tally = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (tally >= 8 - bits) & (np.bitwise_count(x) <= bits)


def _large_list(prints: np.ndarray, free: int, bits: int, labels: np.ndarray) -> np.ndarray:
    """Links of one long list. free: mask of the bits in which its members can differ."""
    n = len(prints)
    if n <= PAIRWISE:
        for i in range(n - 1):
            j = i + 1 + np.flatnonzero(_linked(np.broadcast_to(prints[i], n - i - 1), prints[i + 1 :], bits))
            labels = _merge(labels, np.full(len(j), i), j)
        return labels
    order = np.argsort(prints)
    prints = prints[order]
    places = [np.uint64(1 << p) for p in range(64) if free >> p & 1]
    for k in range(1, bits + 1):
        for chosen in combinations(places, k):
            other = prints ^ np.bitwise_or.reduce(np.array(chosen, np.uint64))
            at = np.minimum(np.searchsorted(prints, other), n - 1)
            i = np.flatnonzero((prints[at] == other) & (at < np.arange(n)))
            labels = _merge(labels, i, at[i])
    back = np.empty(n, np.int64)
    back[order] = order[labels]
    return back


def _choices(bits: int) -> list[int]:
    """Masks of every choice of 8 - bits bytes."""
    return [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(8), 8 - bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _stars(choice: np.ndarray, key: np.ndarray, prints: np.ndarray, masks: list[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) of complete posting lists, one after the other."""
    n = len(prints)
    new = np.ones(n, bool)
    new[1:] = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
    begins = np.flatnonzero(new)
    length = np.diff(np.append(begins, n))
    run = np.repeat(np.arange(len(begins)), length)
    labels = np.arange(n)
    small = length <= SMALL
    for step in range(1, int(length[small].max(initial=1))):
        i = np.flatnonzero((run[step:] == run[:-step]) & small[run[step:]]) if step < n else np.zeros(0, np.int64)
        hit = i[_linked(prints[i], prints[i + step], bits)]
        labels = _merge(labels, hit, hit + step)
    for r in np.flatnonzero(~small):
        a, b = begins[r], begins[r] + length[r]
        free = ~masks[choice[a]] & (1 << 64) - 1
        labels[a:b] = a + _large_list(prints[a:b], free, bits, np.arange(b - a))
    out = np.flatnonzero(labels != np.arange(n))
    return prints[out], prints[labels[out]]


def _search(masks: list[int], bits: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def done(rows):
            a, b = _stars(*rows, masks, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            choice, key = (batch.column(i).to_numpy() for i in (0, 1))
            prints = batch.column(2).to_numpy().view(np.uint64)
            changes = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            last = int(changes[-1]) if len(changes) else 0
            if held and (held[-1][0][-1], held[-1][1][-1]) != (choice[0], key[0]):
                cut = 0  # the held list is complete
            else:
                cut = int(changes[0]) if len(changes) else len(prints)
            if held:
                held.append((choice[:cut], key[:cut], prints[:cut]))
                if not len(changes) and cut:
                    continue  # the list goes on
                yield done(tuple(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            else:
                cut = 0
            if last > cut:
                yield done((choice[cut:last], key[cut:last], prints[cut:last]))
            held = [(choice[max(cut, last) :], key[max(cut, last) :], prints[max(cut, last) :])]
        if held:
            yield done(tuple(np.concatenate(c) for c in zip(*held, strict=True)))

    return search


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b): enough links between fingerprints for all that differ in at most `bits` bits to be reachable.

    distinct: a table of distinct fingerprints (column fingerprint, signed long).
    """
    masks = _choices(bits)
    postings = F.explode(F.array(*[F.struct(F.lit(c).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key")) for c, m in enumerate(masks)]))
    posted = distinct.select(postings.alias("p"), "fingerprint").select("p.choice", "p.key", "fingerprint")
    dealt = posted.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return dealt.mapInArrow(_search(masks, bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge (a, b), and the least node reachable from it."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # Large star: every larger neighbour is linked to the least of the neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours are linked to the least of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = staged(small, "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if before == (state["n"], state["h"]):
            break
        before = (state["n"], state["h"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def rooted_fingerprints(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """distinct with root: the least fingerprint reachable from the row's own by links of at most `bits` bits."""
    roots = components(links(distinct.select("fingerprint"), bits)).withColumnRenamed("node", "fingerprint")
    return distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def least_of_groups(docs: DataFrame, words: int = 3, bits: int = BITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row of each group: doc_id and the columns to keep of that with the least doc_id.

    Null ids come last; rows of one id are ordered by a hash of what is kept, so that
    only rows equal in all of it can stand for each other. The row that stays is found by
    a number that it has once written, so no join or window meets a group as a whole.
    """
    number = F.monotonically_increasing_id()  # unique in the job that writes it, and data from then on
    marked = staged(fingerprints(docs, words, keep).withColumn("_row", number), "marked")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*keep).alias("hash"), "_row")
    distinct = staged(marked.groupBy("fingerprint").agg(F.min(own).alias("least")), "distinct")
    first = rooted_fingerprints(distinct, bits).groupBy("root").agg(F.min("least").alias("least"))
    return marked.join(first.select(F.col("least._row").alias("_row")), "_row", "left_semi").drop("_row", "fingerprint")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id (least doc_id reachable) of every row."""
    prints = staged(fingerprints(docs, words), "fingerprints")
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = rooted_fingerprints(distinct, bits)
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")

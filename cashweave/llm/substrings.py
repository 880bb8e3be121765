"""Substring dedup: windows of words that an earlier document has are removed.

Every window of `window` consecutive words gets a Rabin-Karp hash. Windows travel
packed: one row for a bucket of hashes and a batch of texts, with hashes, document
ids and places as byte planes, about eight bytes a window. Within a batch, a window
that several documents of the batch have sends on only the smallest of them (and
decides the rest on the spot), so that a passage which stands in a third of all
documents arrives as one entry for each batch. A bucket's task finds the smallest
document of every hash; what has to go returns packed by document, is merged into
maximal intervals, and meets the texts in one join on the document.

Hashes keep 56 bits and the bucket's bits, 62 at least.

Defined cases: a null text has no words; a null id is neither smaller nor larger
than any id, so such rows keep all words and cause no removals; rows that repeat
an id are one document to each other (a window is never removed because of the
same id); an empty table gives an empty result; of further columns only those named
in `keep` are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashweave.llm.base import planes, slices, table, unnamed, unplanes
from cashweave.llm.tokens import spans, window_hashes, word_hashes

BATCH_WINDOWS = 1 << 19
BUCKET_WINDOWS = 1 << 20
HASH_BYTES = 7
_PACKED = "bucket int, hashes binary, docs binary, twins binary, places binary"
_MARKS = "bucket int, docs binary, twins binary, places binary"
_REMOVALS = "doc_id long, twin int, starts binary, ends binary"


def _delta(x: np.ndarray) -> np.ndarray:
    """Differences of successive values as unsigned numbers, small ones first (zigzag)."""
    d = np.diff(x.astype(np.int64), prepend=np.int64(0))
    return ((d << 1) ^ (d >> 63)).view(np.uint64)


def _undelta(z: np.ndarray) -> np.ndarray:
    d = (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)
    return np.cumsum(d)


def _steps(places: np.ndarray, docs: np.ndarray, twins: np.ndarray) -> np.ndarray:
    """Each place less the one before in the same text; rising places give small numbers."""
    d = np.diff(places.astype(np.int64), prepend=np.int64(0))
    new = _runs(docs, twins)
    d[new] = places[new]
    return d


def _unsteps(steps: np.ndarray, docs: np.ndarray, twins: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps.astype(np.uint32).view(np.int32).astype(np.int64))
    new = _runs(docs, twins)
    before = np.where(new > 0, total[new - 1], 0)
    return total - np.repeat(before, np.diff(np.append(new, len(steps))))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the (sorted) keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _doc_bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _decided(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is it of the smallest document of its hash; order is as given."""
    order = np.argsort(hashes, kind="stable")
    begins = _runs(hashes[order])
    sorted_docs = docs[order]
    if len(begins):
        sorted_docs -= np.repeat(np.minimum.reduceat(sorted_docs, begins), np.diff(np.append(begins, len(docs))))
    smallest = np.empty(len(docs), bool)
    smallest[order] = sorted_docs == 0
    return smallest, order


def _rows(bucket: np.ndarray, buckets: int, schema: pa.Schema, docs: np.ndarray, twins: np.ndarray, places: np.ndarray, hashes: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One packed row for each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(edges))
    out: dict[str, list] = {name: [] for name in schema.names}
    for b in full:
        take = order[edges[b] : edges[b + 1]]
        doc, twin = docs[take], twins[take]
        out["bucket"].append(int(b))
        out["docs"].append(planes(_delta(doc), 8))
        out["twins"].append(planes(_delta(twin), 4))
        out["places"].append(planes(_steps(places[take], doc, twin), 4))
        if hashes is not None:
            out["hashes"].append(planes(hashes[take], HASH_BYTES))
    if len(full):
        yield pa.RecordBatch.from_pydict(out, schema=schema)


_MARK_SCHEMA = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("twins", pa.binary()), ("places", pa.binary())])
_PACKED_SCHEMA = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("twins", pa.binary()), ("places", pa.binary())])


def _window_packer(window: int, bits: int, doc_buckets: int):
    """Packs the windows of batches of texts. Buckets below zero hold removals decided here."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            hashes, docs, twins, places = (np.concatenate(c) for c in zip(*held, strict=True))
            smallest, _ = _decided(hashes, docs)
            gone = ~smallest
            if gone.any():
                for row in _rows(_doc_bucket(docs[gone], doc_buckets), doc_buckets, _MARK_SCHEMA, docs[gone], twins[gone], places[gone]):
                    yield pa.RecordBatch.from_arrays([pa.array(-1 - row.column(0).to_numpy(), pa.int32()), pa.array([b""] * row.num_rows, pa.binary()), *row.columns[1:]], schema=_PACKED_SCHEMA)
            hashes, docs, twins, places = hashes[smallest], docs[smallest], twins[smallest], places[smallest]
            top = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            yield from _rows(top, 1 << bits, _PACKED_SCHEMA, docs, twins, places, hashes)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            twin = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            for lo, _, data, at in slices(batch.column(2)):
                starts, ends, first = spans(data, at)
                hashes, text, places = window_hashes(word_hashes(data, starts, ends), first, window)
                held.append((hashes, ids[lo:][text], twin[lo:][text], places.astype(np.int32)))
                size += len(hashes)
                if size >= BATCH_WINDOWS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return pack


def _joined(raws: pa.ChunkedArray, width: int, kind: type, value) -> np.ndarray:
    """One column of packed rows as one array; beside it only one row is unpacked at a time."""
    buffers = [raw.as_buffer() for raw in raws]
    ends = np.cumsum([0, *(b.size // width for b in buffers)]).tolist()
    out = np.empty(ends[-1], kind)
    for at, end, raw in zip(ends[:-1], ends[1:], buffers, strict=True):
        out[at:end] = value(unplanes(raw, width), slice(at, end))
    return out


def _unpack(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs = _docs(rows)
    return docs, *_twins_places(rows, docs)


def _docs(rows: pa.Table) -> np.ndarray:
    return _joined(rows.column("docs"), 8, np.int64, lambda z, _: _undelta(z))


def _twins_places(rows: pa.Table, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    twins = _joined(rows.column("twins"), 4, np.int32, lambda z, _: _undelta(z))
    places = _joined(rows.column("places"), 4, np.int32, lambda z, at: _unsteps(z, docs[at], twins[at]))
    return twins, places


def _judge(doc_buckets: int):
    """All windows of one bucket: those not of the smallest document go."""

    def judge(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:  # decided before
            return pa.table([pa.array([-1 - b for b in rows.column("bucket").to_pylist()], pa.int32()), *(rows.column(c) for c in ("docs", "twins", "places"))], schema=_MARK_SCHEMA)
        hashes = _joined(rows.column("hashes"), HASH_BYTES, np.uint64, lambda z, _: z)
        docs = _docs(rows)
        gone = ~_decided(hashes, docs)[0]
        del hashes
        twins, places = _twins_places(rows, docs)
        docs, twins, places = docs[gone], twins[gone], places[gone]
        order = np.lexsort((places, docs))
        docs, twins, places = docs[order], twins[order], places[order]
        packed = list(_rows(_doc_bucket(docs, doc_buckets), doc_buckets, _MARK_SCHEMA, docs, twins, places))
        return pa.Table.from_batches(packed, schema=_MARK_SCHEMA)

    return judge


def _intervals(window: int):
    """All removals of one bucket of documents, merged into maximal intervals of words."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        docs, twins, places = _unpack(rows)
        order = np.lexsort((places, twins, docs))
        docs, twins, places = docs[order], twins[order], places[order]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (twins[1:] != twins[:-1]) | (places[1:] > places[:-1] + window)
        begins = np.flatnonzero(new)
        ends = places[np.append(begins[1:], len(docs)) - 1] + window
        owner = _runs(docs[begins], twins[begins])
        edge = np.append(owner, len(begins))
        start = places[begins]
        return pa.table(
            {
                "doc_id": pa.array(docs[begins][owner], pa.int64()),
                "twin": pa.array(twins[begins][owner], pa.int32()),
                "starts": pa.array([start[a:b].astype("<i4").tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()),
                "ends": pa.array([ends[a:b].astype("<i4").tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()),
            }
        )

    return merge


def _cut(text: str, starts: bytes | None, ends: bytes | None, layout: bool) -> tuple[int, int, str]:
    """(words, words removed, what is left). layout: white space after kept words stays as it was."""
    words = text.encode().split()
    if not starts:
        return len(words), 0, text if layout else b" ".join(words).decode()
    cut = list(zip(np.frombuffer(starts, "<i4").tolist(), np.frombuffer(ends, "<i4").tolist(), strict=True))
    removed = sum(b - a for a, b in cut)
    if layout:
        data = np.frombuffer(text.encode(), np.uint8)
        at, _, _ = spans(data, np.array([0, len(data)]))
        edges = np.append(at, len(data))
        edges[0] = 0
        raw, parts, last = data.tobytes(), [], 0
        for a, b in cut:
            parts.append(raw[last : edges[a]])
            last = edges[b]
        return len(words), removed, b"".join([*parts, raw[last:]]).decode()
    kept, last = [], 0
    for a, b in cut:
        kept += words[last:a]
        last = b
    return len(words), removed, b" ".join(kept + words[last:]).decode()


def dedup_substrings(docs: DataFrame, window: int = 13, keep: tuple[str, ...] = (), layout: bool = False) -> DataFrame:
    """doc_id, the `keep` columns, n_words, n_removed, removed (intervals of words), kept_text.

    docs needs doc_id (integer) and text. With `layout`, the white space between
    kept words is left as it was; else one space joins them.
    """
    source = unnamed(docs, "doc_id", "text", *keep).withColumn("doc_id", F.col("doc_id").cast("long"))
    # Sizes of the buckets, and whether an id occurs more than once; text is only measured.
    facts = source.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).where("doc_id is not null").agg(F.max("n").alias("n"), F.sum("b").alias("b")).first()
    windows = (facts["b"] or 0) // 6 + 1
    bits = max(6, (windows // BUCKET_WINDOWS).bit_length())
    buckets = 1 << bits
    # Rows of one id are told apart by their text; where ids are unique there is nothing to tell.
    twin = (F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)) if (facts["n"] or 0) > 1 else F.lit(0)).cast("int")
    source = source.withColumn("twin", F.coalesce(twin, F.lit(0)))
    packed = source.where("doc_id is not null").select("doc_id", "twin", "text").mapInArrow(_window_packer(window, bits, buckets), _PACKED)
    marks = packed.groupBy("bucket").applyInArrow(_judge(buckets), _MARKS)
    removals = marks.groupBy("bucket").applyInArrow(_intervals(window), _REMOVALS)
    extra = [f for f in source.schema.fields if f.name in keep]
    joined = source.join(removals.hint("shuffle_hash"), ["doc_id", "twin"], "left").select("doc_id", "text", "starts", "ends", *[F.col(f"`{c}`") for c in keep])
    schema = ", ".join(["doc_id long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in extra], "n_words long", "n_removed long", "removed array<struct<first:int,end:int>>", "kept_text string"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        removed_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for lo, hi, _, _ in slices(whole.column(1)):
                batch = whole.slice(lo, hi - lo)
                starts, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                done = [_cut(t or "", s, e, layout) for t, s, e in zip(batch.column(1).to_pylist(), starts, ends, strict=True)]
                cuts = [[{"first": int(x), "end": int(y)} for x, y in zip(np.frombuffer(s, "<i4"), np.frombuffer(e, "<i4"), strict=True)] if s else [] for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *batch.columns[4:], pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array(cuts, removed_type), pa.array([d[2] for d in done], pa.string())],
                    names=["doc_id", *keep, "n_words", "n_removed", "removed", "kept_text"],
                )

    return joined.mapInArrow(finish, schema)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    done = dedup_substrings(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
hashed AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM windows),
least AS (SELECT win, min(doc_id) AS least FROM hashed GROUP BY win),
gone AS (
  SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 13)) AS i
  FROM hashed h JOIN least l USING (win) WHERE l.least < h.doc_id),
cut AS (SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words,
         list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(cut, []), i)), lambda i: w[i]) AS k
  FROM words LEFT JOIN cut USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_words - len(k) AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""

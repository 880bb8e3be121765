"""Toxicity by compression distance: which of two zstandard dictionaries tells a window shorter.

One dictionary is trained on windows of toxic texts, one on windows of ordinary texts.
A window is `WORDS` words, lower-cased (A-Z). It is compressed with either dictionary
behind a fixed frame that both know (otherwise the format stores such short inputs as
they are); the difference in length is the window's distance. A text's score comes
from how many of its windows reach a threshold, by a calibrated logistic curve.

Learning takes a bounded sample of labelled texts: for each label those whose ids hash
lowest, `SAMPLE` of them and SAMPLE_BYTES at most; a very long one by its first part. Half of it trains dictionaries: the
toxic one on windows that toxic texts have far more often than others. How many kinds
of windows, and which threshold, is chosen on the other half, where the curve is
fitted. All texts are scored whole.

A window's distance depends on nothing else, so tasks remember the distances of
windows seen lately in a memory of fixed size.

Defined cases: a null or empty text has no windows, and the score of a text without
hits; null labels teach nothing; without labels of both kinds, or without a window that
sets them apart, every score is the share of toxic labels (0 without labels); repeated
rows are rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import fold, hashed_sample, slices, table, unnamed

WORDS = 1
SAMPLE = 3000
SAMPLE_BYTES = 24 << 20
#: One text has at most this part of its label's bytes.
LONGEST_SHARE = 16
KINDS = (8, 16, 32, 64, 128, 512)
THRESHOLDS = (1, 2, 3, 4, 5)
LEVEL = 6
MOST_WINDOW = 256
MEMORY = 300_000
FRAME = b"0123456789~abcdefghijklmnopqrs~"
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def windows(text: str | None) -> list[bytes]:
    words = (text or "").encode().translate(_LOWER).split()
    return words if WORDS == 1 else [b" ".join(words[i : i + WORDS]) for i in range(0, len(words), WORDS)]


def _framed(window: bytes) -> bytes:
    return FRAME + b" " + window + b" "


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of windows; too few for the trainer become its content as they are."""
    framed = [_framed(w) for w in samples]
    try:
        return zstandard.train_dictionary(size, framed, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(b" " + w + b" " for w, _ in reversed(Counter(samples).most_common()))[-size:] + FRAME


class Distances(dict):
    """Window to distance: bytes saved by the toxic dictionary; what was used lately is kept."""

    def __init__(self, toxic: bytes, ordinary: bytes, memory: int = MEMORY):
        super().__init__()
        self.size, self.old = memory, {}
        self.toxic, self.ordinary = (self._lengths(d) for d in (toxic, ordinary))

    @staticmethod
    def _lengths(content: bytes):
        known = zstandard.ZstdCompressionDict(content)
        plan = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=len(content), source_size=64, strategy=zstandard.STRATEGY_LAZY, min_match=4, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False
        )
        known.precompute_compress(compression_params=plan)
        return zstandard.ZstdCompressor(dict_data=known, compression_params=plan).compress

    def __missing__(self, window: bytes) -> int:
        value = self.old.get(window)
        if value is None:
            # A longer window is the sum of its parts, so that none is cut off.
            value = 0
            for i in range(0, len(window), MOST_WINDOW):
                framed = _framed(window[i : i + MOST_WINDOW])
                value += len(self.ordinary(framed)) - len(self.toxic(framed))
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[window] = value
        return value


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    threshold: int
    weights: tuple[float, ...]
    prior: float


def _evidence(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the curve sees of texts: any hit, how many, and how dense."""
    return np.stack([np.ones(len(hits)), hits > 0, np.log1p(hits), np.log1p(100 * hits / np.maximum(n, 1))], axis=1)


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small penalty, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
    return w


def _distinct(toxic: list[list[bytes]], ordinary: list[list[bytes]], most: int) -> list[bytes]:
    """The windows that set toxic texts apart, by significance over texts; at most `most`."""
    a, b = (Counter(w for t in texts for w in set(t)) for texts in (toxic, ordinary))
    m, n = len(toxic), len(ordinary)
    worth = {}
    for w, k in a.items():
        p, q = k / m, (b[w] + 0.5) / (n + 1)
        if k >= 5 and p > 4 * q:
            worth[w] = k * math.log(p / q)
    return sorted(worth, key=lambda w: (-worth[w], w))[:most]


def learn(rows: list[tuple[int, str, int]]) -> Model:
    """rows: (anything hashed, text, toxic 0 or 1); even places train, odd ones calibrate."""
    prior = sum(r[2] for r in rows) / len(rows) if rows else 0.0
    parts = [[windows(t) for _, t, y in rows[h::2] if y == label] for label in (1, 0) for h in (0, 1)]
    toxic, toxic_held, ordinary, ordinary_held = parts
    if not all(parts):
        return Model(b"", b"", 0, (), prior)
    ranked = _distinct(toxic, ordinary, max(KINDS))
    plain = [w for t in ordinary for w in t]
    step = max(1, len(plain) // 40_000)
    held = toxic_held + ordinary_held
    y = np.repeat([1.0, 0.0], [len(toxic_held), len(ordinary_held)])
    n = np.array([len(t) for t in held])
    best, chosen = -math.inf, Model(b"", b"", 0, (), prior)
    ordinary_dict = train(plain[::step], 8192)
    for kinds in KINDS:
        if not ranked or kinds > 2 * len(ranked):
            break
        apart = set(ranked[:kinds])
        samples = [w for t in toxic for w in t if w in apart]
        toxic_dict = train(samples, max(256, min(8192, 2 * sum(len(w) + 2 for w in apart) + len(FRAME))))
        distances = Distances(toxic_dict, ordinary_dict)
        each = [np.array([distances[w] for w in t] or [0]) for t in held]
        for threshold in THRESHOLDS:
            hits = np.array([(d >= threshold).sum() for d in each])
            x = _evidence(hits, n)
            weights = _curve(x, y)
            z = np.clip(x @ weights, -30, 30)
            likelihood = float((y * z - np.log1p(np.exp(z))).sum())
            if likelihood > best + 1e-9:
                best, chosen = likelihood, Model(toxic_dict, ordinary_dict, threshold, tuple(weights.tolist()), prior)
    return chosen


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> list[tuple[int, str, int]]:
    """For each label the texts whose ids hash lowest, within both bounds."""
    marked = unnamed(labels, "doc_id", "toxic").where("toxic is not null").distinct()
    rows: list[tuple[int, str, int]] = []
    for label in (1, 0):
        ids = hashed_sample(marked.where(F.col("toxic") == label).select("doc_id"), "doc_id", most)
        texts = unnamed(docs, "doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        # A very long text teaches by its first part, so that it leaves room for others.
        texts = texts.limit(most).withColumn("text", F.left("text", F.lit(max(1, most_bytes // 2 // LONGEST_SHARE))))
        taken = 0
        for row in texts.toLocalIterator():
            if taken + len(row["text"]) > most_bytes // 2:
                continue  # shorter ones may still fit
            taken += len(row["text"])
            rows.append((row["doc_id"], row["text"], label))
    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_windows, hits and score of every row."""
    weights, threshold = np.array(model.weights), model.threshold

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = Distances(model.toxic, model.ordinary) if len(weights) else None
        for whole in batches:
            for lo, hi, _, _ in slices(whole.column(1)):
                n, hits = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                for i, text in enumerate(whole.column(1).slice(lo, hi - lo).to_pylist()):
                    own = windows(text)
                    n[i] = len(own)
                    if distances is not None:
                        hits[i] = sum([distances[w] >= threshold for w in own])
                if distances is None:
                    scores = np.full(hi - lo, model.prior)
                else:
                    scores = 1 / (1 + np.exp(-np.clip(_evidence(hits, n) @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(lo, hi - lo), pa.array(n), pa.array(hits), pa.array(scores)], names=["doc_id", "n_windows", "hits", "score"])

    source = unnamed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(batches_of, "doc_id long, n_windows long, hits long, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    scored = score(docs, learn(sample(docs, labels)))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")

"""Language identification as a mixture: shares of languages by expectation-maximisation.

A language is a table of probabilities of byte trigrams (lower-cased A-Z, a space on
either side of a word, hashed to a fixed number of cells), counted over all texts that
teach it. A text is a mixture: each word was drawn from one language, with the
likelihood of its trigrams there. Expectation-maximisation estimates the shares. A
set of k languages pays a penalty for each further one; of the sets made of the
largest shares the one with the best penalised likelihood is kept.

The driver holds one table of CELLS numbers for each language, whatever the number of
texts; counts are summed in Spark with partial sums in every task.

Defined cases: a null text or one without a letter is `und` with score 0 and no
languages, and so is every text if nothing teaches; null labels teach nothing; ties go
to the language that is first by name; repeated rows are rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import fold, slices, table, unnamed
from cashweave.llm.tokens import SPACE, spans

CELLS = 1 << 15
ROUNDS = 12
SMOOTHING = 0.5
#: Log-likelihood that a further language must add, and for each tenfold of words.
PENALTY = 8.0
UNDETERMINED = "und"
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[0x41:0x5B] += 32
_LOWER[SPACE] = 0x20


def trigram_cells(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every byte the cell of the trigram around it; ends of texts count as spaces."""
    low = _LOWER[data]
    before, after = np.full(len(low), 0x20, np.uint32), np.full(len(low), 0x20, np.uint32)
    before[1:], after[:-1] = low[:-1], low[1:]
    inner = at[1:-1]
    before[inner[inner < len(low)]] = 0x20
    after[inner[(inner > 0)] - 1] = 0x20
    key = (before << np.uint32(16)) | (low << np.uint32(8)) | after
    key = key * np.uint32(0x9E3779B1)
    return (key ^ (key >> np.uint32(15))) % np.uint32(CELLS)


@dataclass(frozen=True)
class Languages:
    names: list[str]
    logs: np.ndarray  # CELLS x languages


def learn(docs: DataFrame) -> Languages:
    """From all rows of docs (text, lang) that have a lang."""

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(0)):
                langs = np.array(batch.column(1).slice(lo, hi - lo).to_pylist(), object)
                cells = trigram_cells(data, at)
                word = ~SPACE[data]
                names, which = np.unique(langs, return_inverse=True)
                owner = np.repeat(which, np.diff(at))
                found = np.bincount(owner[word] * CELLS + cells[word], minlength=len(names) * CELLS).reshape(len(names), CELLS)
                for name, row in zip(names, found, strict=True):
                    totals[name] = totals.get(name, 0) + row
        for name, row in totals.items():
            full = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(full)), pa.array(full.astype(np.int32)), pa.array(row[full])], names=["lang", "cell", "n"])

    taught = unnamed(docs, "text", "lang").where("lang is not null and text is not null")
    rows = taught.mapInArrow(counts_of, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    counts = np.zeros((CELLS, len(names)))
    counts[rows["cell"], [names.index(x) for x in rows["lang"]]] = rows["n"]
    return Languages(names, np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * CELLS)).astype(np.float32))


def _maximise(p: np.ndarray, first: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihood) of texts after rounds of expectation-maximisation; first bounds texts without gaps."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    for _ in range(rounds):
        drawn = p * shares[text]
        drawn /= drawn.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(drawn, first[:-1], axis=0) / counts[:, None]
    likely = np.add.reduceat(np.log((p * shares[text]).sum(axis=1)), first[:-1])
    return shares, likely


def mixtures(logs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The shares (texts x languages) of the chosen set. logs: log-likelihood of each word in each language."""
    counts, langs = np.diff(first), logs.shape[1]
    out = np.zeros((len(counts), langs))
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    edges = np.concatenate([[0], np.cumsum(counts[full])])
    top = logs.max(axis=1, keepdims=True)
    p = np.exp(np.maximum(logs - top, -60)).astype(np.float64)
    alone = np.add.reduceat(np.log(p), edges[:-1], axis=0)
    single = alone.argmax(axis=1)
    best = alone.max(axis=1)
    out[full, single] = 1.0
    penalty = PENALTY * (1 + np.log10(counts[full]))
    # Even with no word against it, a mixture cannot do better than zero here.
    open_ = np.flatnonzero(-best > penalty)
    if langs < 2 or not len(open_):
        return out
    take = np.concatenate([np.arange(edges[d], edges[d + 1]) for d in open_])
    p, edges = p[take], np.concatenate([[0], np.cumsum(counts[full][open_])])
    shares, _ = _maximise(p, edges, np.full((len(open_), langs), 1 / langs), ROUNDS)
    rank = (-shares).argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
    score = best[open_].copy()
    for k in range(2, langs + 1):
        some = np.where(rank < k, shares, 0)
        some, likely = _maximise(p, edges, some / some.sum(axis=1, keepdims=True), ROUNDS // 2)
        value = likely - penalty[open_] * (k - 1)
        better = value > score
        score[better] = value[better]
        out[full[open_[better]]] = some[better]
    return out


def identify(docs: DataFrame, languages: Languages, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the `keep` columns, lang_pred, score (its share), languages and shares of every row."""
    names, table_ = languages.names, languages.logs

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi, data, at in slices(whole.column(1)):
                batch = whole.slice(lo, hi - lo)
                starts, ends, first = spans(data, at)
                letters = np.array([any(map(str.isalpha, t or "")) for t in batch.column(1).to_pylist()], bool)
                shares = np.zeros((hi - lo, max(1, len(names))))
                if names and len(starts):
                    each = table_[trigram_cells(data, at)]
                    sums = np.add.reduceat(each, np.stack([starts, ends], axis=1).reshape(-1)[:-1] if ends[-1] == len(data) else np.stack([starts, ends], axis=1).reshape(-1), axis=0)[::2]
                    shares = mixtures(sums, first)
                known = letters & (shares.sum(axis=1) > 0)
                chosen, best = shares.argmax(axis=1), shares.max(axis=1)
                sets = [[names[j] for j in np.argsort(-s, kind="stable") if s[j] > 0] if k else [] for s, k in zip(shares, known, strict=True)]
                parts = [sorted((float(x) for x in s if x > 0), reverse=True) if k else [] for s, k in zip(shares, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *(batch.column(c) for c in keep),
                        pa.array([names[c] if k else UNDETERMINED for c, k in zip(chosen, known, strict=True)], pa.string()),
                        pa.array(np.where(known, np.minimum(best, 1.0), 0.0)),
                        pa.array(sets, pa.list_(pa.string())),
                        pa.array(parts, pa.list_(pa.float64())),
                    ],
                    names=["doc_id", *keep, "lang_pred", "score", "languages", "shares"],
                )

    source = unnamed(docs, *dict.fromkeys(["doc_id", "text", *keep])).withColumn("doc_id", F.col("doc_id").cast("long"))
    extra = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name in keep]
    return source.mapInArrow(batches_of, ", ".join(["doc_id long", *extra, "lang_pred string, score double, languages array<string>, shares array<double>"]))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs.where(fold("doc_id", 5) != 0)))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", F.array_join("languages", "+").alias("languages"))

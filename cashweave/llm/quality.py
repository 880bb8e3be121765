"""Quality rules: a decision list learned from labelled statistics, as a Spark expression.

Statistics of every text come from one vectorised pass. The list is learned by
sequential covering: grow a conjunction of thresholds on two thirds of the labelled
rows by the gain in information, prune its last conditions on the other third, keep
it if it is precise there, take away what it covers, go on. The list becomes one
WHEN ... WHEN ... OTHERWISE expression over the statistics, so applying it costs no
Python and no join.

Learning takes a bounded sample: the `sample` labelled rows whose ids hash lowest.
All texts are measured and judged.

Defined cases: a null text has no words; rows with null ids, null labels or several
labels are judged (once each) but a null label teaches nothing; without labels of both
kinds the list is empty and keeps all; an empty table gives an empty result; columns
other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import hashed_sample, slices, staged, table, unnamed
from cashweave.llm.tokens import SPACE, mix, spans, window_hashes, word_hashes

SAMPLE = 20_000
REPEAT_WINDOW = 5
PRECISION = 0.9
MOST_RULES = 16
MOST_CONDITIONS = 4
CUTS = 32

_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(0x41, 0x5B))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(0x61, 0x7B)) | (np.arange(256) >= 0xC0)
_DIGIT = np.isin(np.arange(256), np.arange(0x30, 0x3A))
_PUNCT = np.isin(np.arange(256), list(b".,;:!?\"'()-"))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_punct")


def _each(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between successive places."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] - total[at[:-1]]


def _copies(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is its hash in its text twice or more, and is it not the first of its hash."""
    with np.errstate(over="ignore"):
        key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    later[order[1:]] = same
    return again, later


def measure(data: np.ndarray, at: np.ndarray, window: int = REPEAT_WINDOW) -> list[np.ndarray]:
    """COUNTS of texts that stand end to end in data."""
    starts, ends, first = spans(data, at)
    words = np.diff(first)
    in_word = ~SPACE[data]
    hashes, text, place = window_hashes(word_hashes(data, starts, ends), first, window)
    again, _ = _copies(hashes, text)
    from_ = (first[text] + place)[again]
    edge = np.bincount(from_, minlength=len(starts) + 1) - np.bincount(np.minimum(from_ + window, len(starts)), minlength=len(starts) + 1)
    covered = np.cumsum(edge)[: len(starts)] > 0
    # Lines: what stands between line feeds and ends of texts, if it has a word.
    feed = np.flatnonzero(data == 0x0A)
    cuts = np.unique(np.concatenate([feed, at - 1, [len(data) - 1]])) if len(data) else np.zeros(0, np.int64)
    cuts = cuts[cuts >= 0]
    line_from = np.concatenate([[0], cuts[:-1] + 1]) if len(cuts) else cuts
    is_feed = np.zeros(len(data), bool)
    is_feed[feed] = True
    line_to = cuts + (~is_feed[cuts]).astype(np.int64)
    full = _each(in_word, np.concatenate([line_from, [len(data)]])) > 0 if len(cuts) else np.zeros(0, bool)
    line_from, line_to = line_from[full], line_to[full]
    owner = np.searchsorted(at, line_from, "right") - 1
    _, later = _copies(word_hashes(data, line_from, line_to), owner) if len(line_from) else (None, np.zeros(0, bool))
    rows = len(at) - 1
    return [
        words,
        _each(in_word & ~_CONTINUED[data], at),
        _each(_SYMBOL[data], at),
        np.bincount(owner[later], minlength=rows),
        _each(covered, first),
        np.bincount(owner, minlength=rows),
        *(_each(kind[data], at) for kind in (_UPPER, _LETTER, _DIGIT, _PUNCT)),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS (long) of every row of docs (doc_id, text)."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(c.astype(np.int64)) for c in measure(data, at))], names=["doc_id", *COUNTS])

    source = unnamed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(batches_of, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)]))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


#: What conditions may ask for, from the counts.
FEATURES = {
    "words": F.col,
    "word_length": lambda _: _share("word_chars", "n_words"),
    "symbols": lambda _: _share("n_symbols", "n_words"),
    "repeats": lambda _: _share("n_repeat_words", "n_words"),
    "copied_lines": lambda _: _share("n_dup_lines", "n_lines"),
    "line_words": lambda _: _share("n_words", "n_lines"),
    "upper": lambda _: _share("n_upper", "n_letters"),
    "letters": lambda _: _share("n_letters", "word_chars"),
    "digits": lambda _: _share("n_digits", "word_chars"),
    "punctuation": lambda _: _share("n_punct", "n_words"),
}


def feature(name: str) -> Column:
    return F.col("n_words").cast("double") if name == "words" else FEATURES[name](name)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.cut if self.above else values[self.name] <= self.cut

    def column(self) -> Column:
        return feature(self.name) > self.cut if self.above else feature(self.name) <= self.cut


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """Gain in information on the covered bad rows (p), for candidates that leave p and n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    inside, rule = np.ones(len(bad), bool), []
    while len(rule) < MOST_CONDITIONS and (~bad[inside]).any():
        best, chosen = 1e-9, None
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        for name, v in values.items():
            cuts = np.unique(np.quantile(v[inside], np.linspace(0, 1, CUTS + 2)[1:-1]))
            for above in (True, False):
                hits = (v[inside][None, :] > cuts[:, None]) if above else (v[inside][None, :] <= cuts[:, None])
                gains = _gain((hits & bad[inside]).sum(axis=1), (hits & ~bad[inside]).sum(axis=1), p0, n0)
                i = int(np.argmax(gains))
                if gains[i] > best:
                    best, chosen = gains[i], Condition(name, above, float(cuts[i]))
        if chosen is None:
            break
        rule.append(chosen)
        inside &= chosen.holds(values)
    return rule


def _covers(rule: list[Condition], values: dict[str, np.ndarray]) -> np.ndarray:
    inside = np.ones(len(next(iter(values.values()))), bool)
    for c in rule:
        inside &= c.holds(values)
    return inside


def _prune(rule: list[Condition], values: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """The beginning of the rule that tells best on rows it was not grown on; shorter if equal."""

    def worth(k: int) -> float:
        inside = _covers(rule[:k], values)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray, precision: float = PRECISION) -> list[list[Condition]]:
    """Rules that reject, in order. bad: the labelled rows to reject."""
    rules: list[list[Condition]] = []
    open_ = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < MOST_RULES and bad[open_ & ~third].any():
        grow, prune = open_ & ~third, open_ & third
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        rule = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        if not rule:
            break
        inside = _covers(rule, values)
        p, n = (bad & inside & prune).sum(), (~bad & inside & prune).sum()
        if p < 2 or p < precision * (p + n):
            break
        rules.append(rule)
        open_ &= ~inside
    return rules


def as_expression(rules: list[list[Condition]]) -> Column:
    """True if no rule rejects: the rules as ordered WHEN branches."""
    kept = F.lit(True)
    for rule in reversed(rules):
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        kept = F.when(condition, F.lit(False)).otherwise(kept)
    return kept


def decide(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[list[Condition]]]:
    """stats with `verdict` (true: good), and the rules. labels: doc_id and quality (1: good)."""
    labelled = stats.join(unnamed(labels, "doc_id", "quality").where("quality is not null"), "doc_id")
    taken = hashed_sample(labelled.select("doc_id", *[feature(n).alias(n) for n in FEATURES], "quality"), "doc_id", sample)
    rows = taken.toPandas().sort_values(["doc_id", "quality", *FEATURES])
    rows = rows.sample(frac=1, random_state=0)  # thirds of the rows are then alike, in any run
    values = {n: rows[n].to_numpy(float) for n in FEATURES}
    rules = learn(values, rows["quality"].to_numpy() == 0) if len(rows) else []
    return stats.withColumn("verdict", as_expression(rules)), rules


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept of every row."""
    judged, _ = decide(staged(statistics(docs), "statistics"), labels, sample)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *COUNTS, base.alias("base_failed"), (~base & F.col("verdict")).alias("kept"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

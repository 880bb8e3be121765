"""Filter interaction audit: what each filter removes in every order, and its Shapley share.

Filters remove documents. Whatever the order, a coalition S of filters has removed the
documents that fail one of them, v(S) in number; so all orders follow from the counts of
documents by the set of filters they fail, at most 2**n rows a part. These counts are the
only thing taken from the table, with partial sums in every task.

The Hart-Mas-Colell potential of the game v is P(empty) = 0 and

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

built up over the 2**n coalitions; the Shapley value of filter i is P(all) - P(all
without i). n! * P(S) is an integer, so values times n!, the sums over all orders, are
exact. What step k of an order removes is v(first k filters) - v(first k - 1).

Defined cases: a null text counts as an empty one, a null part as the empty string; a
document with a null or unknown id has no labels; of several label rows of an id one with
the mark is enough; a copy is a document whose text some smaller id has (SHA-256 of the
text), so null ids are neither copies nor make any, and rows that repeat an id do not
make each other copies; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import UPPER, staged, table, unnamed

LEAST_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
#: So many filters have 720 orders; more would list too many rows.
MOST_FILTERS = 6
_COUNTS = ["docs", "good", "toxic"]


def text_failures(text: Column) -> dict[str, Column]:
    """Of the filters that read a text alone: does it fail?"""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper > UPPER_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def with_copies(rows: DataFrame, name: str = "E") -> DataFrame:
    """rows (doc_id, digest, ...) and whether some smaller doc_id has the digest.

    The least id of each digest is found with partial results. Rows meet it in a join,
    of which a digest that many rows have is split (its other side has one row)."""
    least = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("_least"))
    return rows.join(least, "digest", "left").withColumn(name, F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))).drop("_least")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E (fails that filter), good and toxic (has the label) of every row of docs."""
    text = F.coalesce("text", F.lit(""))
    read = unnamed(docs, "doc_id", "lang", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        *[failed.alias(name) for name, failed in text_failures(text).items()],
    )
    # The texts are read once; rows are some 50 bytes from here on.
    rows = with_copies(staged(read, "failures"))
    marks = {"good": "quality", "toxic": "toxic"}
    marked = unnamed(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(m) for m, c in marks.items()])
    known = marked.where("doc_id is not null and (good or toxic)")
    return rows.join(known, "doc_id", "left").select("part", *"ABCDE", *[F.coalesce(m, F.lit(False)).alias(m) for m in marks])


def failure_counts(rows: DataFrame, filters: str) -> DataFrame:
    """One row a part: arrays docs, good and toxic, the counts by the set of filters failed (bit i: filter i)."""
    failed = sum((F.col(f).cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    sums = {"docs": F.lit(1), "good": F.col("good").cast("int"), "toxic": F.col("toxic").cast("int")}
    counted = rows.groupBy("part", failed.alias("failed")).agg(*[F.sum(c.cast("long")).alias(m) for m, c in sums.items()])
    cells = [F.array(*[F.coalesce(F.sum(F.when(F.col("failed") == s, F.col(m))), F.lit(0)) for s in range(1 << len(filters))]).alias(m) for m in _COUNTS]
    return counted.groupBy("part").agg(*cells)


def removed(counts: Column, n: int) -> Column:
    """v: for every coalition the number of documents that fail one of its filters."""
    sets = F.sequence(F.lit(0), F.lit((1 << n) - 1))

    def hit(coalition: Column) -> Column:
        failing = F.zip_with(counts, sets, lambda c, s: F.when(s.bitwiseAND(coalition) != 0, c).otherwise(0))
        return F.aggregate(failing, F.lit(0).cast("long"), lambda total, c: total + c)

    return F.transform(sets, hit)


def potentials(v: Column, n: int) -> Column:
    """n! times the potential of every coalition, smaller ones first."""
    players = F.sequence(F.lit(0), F.lit(n - 1))

    def grown(known: Column, coalition: Column) -> Column:
        bits = F.filter(F.transform(players, lambda i: F.call_function("shiftleft", F.lit(1), i)), lambda b: b.bitwiseAND(coalition) != 0)
        smaller = F.aggregate(bits, F.lit(0).cast("long"), lambda total, b: total + F.get(known, coalition - b))
        own = F.call_function("div", F.get(v, coalition) * factorial(n) + smaller, F.size(bits).cast("long"))
        return F.concat(known, F.array(own))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("long")), grown)


def steps(filters: str) -> Column:
    """All steps of all orders: filter_order, step, own (the filter's bit), before (the bits of earlier steps)."""
    rows = []
    for order in permutations(filters):
        before = 0
        for k, f in enumerate(order, 1):
            own = 1 << filters.index(f)
            rows.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k).alias("step"), F.lit(own).alias("own"), F.lit(before).alias("before")))
            before |= own
    return F.array(*rows)


def audit(rows: DataFrame, filters: str) -> DataFrame:
    """Every step of every order of the filters (columns of one letter), for each part of rows.

    rows: part, the filters (true: fails), good and toxic.
    """
    n = len(filters)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {n}")
    games = failure_counts(rows, filters).select("part", "docs", *[removed(F.col(m), n).alias(f"v_{m}") for m in _COUNTS])
    played = games.withColumn("potential", potentials(F.col("v_docs"), n))
    step = played.select("*", F.inline(steps(filters)))
    after, whole = F.col("before") + F.col("own"), (1 << n) - 1

    def here(m: str) -> Column:
        return F.get(f"v_{m}", after) - F.get(f"v_{m}", F.col("before"))

    return step.select(
        "part",
        "filter_order",
        "step",
        (F.get("v_docs", F.lit(whole)) + F.get("docs", F.lit(0)) - F.get("v_docs", after)).alias("kept"),
        here("docs").alias("removed"),
        (F.get("v_docs", F.col("own")) - here("docs")).alias("redundant"),
        F.get("docs", F.col("own")).alias("unique_fails"),
        here("good").alias("good_lost"),
        here("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(whole)) - F.get("potential", F.lit(whole) - F.col("own"))).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "ABCDE")


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce("text", '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), least AS (
  SELECT t, min(doc_id) AS least FROM d WHERE doc_id IS NOT NULL GROUP BY t
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN w.doc_id > l.least THEN 16 ELSE 0 END AS fails
  FROM w LEFT JOIN least l ON l.t = w.t LEFT JOIN marks m ON m.doc_id = w.doc_id
), counted AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT o.filter_order, s.bit AS own, instr(o.filter_order, s.l) AS step,
    (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE instr(o.filter_order, x.l) < instr(o.filter_order, s.l))::INT AS earlier
  FROM orders o, letters s
), told AS (
  SELECT c.part, s.filter_order, s.step, s.own,
    sum(CASE WHEN (c.fails & (s.earlier | s.own)) = 0 THEN c.n ELSE 0 END) AS kept,
    sum(CASE WHEN (c.fails & s.own) <> 0 AND (c.fails & s.earlier) = 0 THEN c.n ELSE 0 END) AS removed,
    sum(CASE WHEN (c.fails & s.own) <> 0 AND (c.fails & s.earlier) <> 0 THEN c.n ELSE 0 END) AS redundant,
    sum(CASE WHEN c.fails = s.own THEN c.n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (c.fails & s.own) <> 0 AND (c.fails & s.earlier) = 0 THEN c.good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (c.fails & s.own) <> 0 AND (c.fails & s.earlier) = 0 THEN c.toxic ELSE 0 END) AS toxic_lost
  FROM counted c, steps s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
"""

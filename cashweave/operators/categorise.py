"""Lookup of the best remark rule: lowest priority number wins."""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashweave.functions.patterns import java_pattern
from cashweave.operators.keyed import lookup_join
from cashweave.scratch import written

# Up to so many rules one expression is the faster form; the answer is the same.
CASE_RULES = 300

# Rules in one expression of the longer form.
CHUNK_RULES = 100

UNCATEGORISED = "uncategorized"

# Fixed value: of rules without a priority.
DEFAULT_PRIORITY = 100


class Rule(NamedTuple):
    raw_pattern: str
    category_code: str
    is_regex: bool
    priority: int


# The rules a fresh installation starts with.
SHIPPED_RULES = [
    Rule("merchant-repayment", "merchant_repayment", False, 10),
    Rule("note-issued-transfer-to-sku", "funds_to_sku", False, 12),
    Rule("transfer-to-sku", "funds_to_sku", False, 12),
    Rule(r"transfer\s*to\s*sku", "funds_to_sku", True, 12),
    Rule(r"note\s*issued\s*transfer\s*to\s*sku", "funds_to_sku", True, 12),
    Rule("fh-admin-fee", "admin_fee", False, 20),
    Rule("acquirer-fee", "mgmt_fee", False, 25),
    Rule("management fee", "mgmt_fee", True, 30),
    Rule("int-diff", "int_diff", False, 35),
    Rule("sr interest", "sr_int", True, 40),
    Rule("sr principal", "sr_prin", True, 40),
    Rule("senior-investor-principal", "sr_prin", False, 40),
    Rule("senior-investor-interest", "sr_int", False, 40),
    Rule("jr interest", "jr_int", True, 50),
    Rule("jr principal", "jr_prin", True, 50),
    Rule("junior-investor-principal", "jr_prin", False, 50),
    Rule("junior-investor-interest", "jr_int", False, 50),
    Rule("spar", "spar", True, 60),
]

# Rules an installation may add for looser repayment remarks.
REPAYMENT_VARIANTS = [
    Rule("merchant repayment", "merchant_repayment", False, 10),
    Rule(r"merchant\s*-\s*repayment", "merchant_repayment", True, 10),
]

RULE_SCHEMA = "raw_pattern string, category_code string, is_regex boolean, priority int"
RULE_KEYS = ["raw_pattern", "category_code"]

Rules = Iterable[Rule] | DataFrame

_REGEX_SIGNS = re.compile(r"[\\^$.|?*+()\[\]{}]")


def rules_frame(spark: SparkSession, rules: Iterable[Rule] = SHIPPED_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def rules_in_order(rules: DataFrame) -> DataFrame:
    """The rule table as people read it."""
    return rules.orderBy("priority", "raw_pattern", "category_code")


def _rank(rule: Rule) -> tuple:
    """Ties on priority are settled by pattern, then code."""
    return rule.priority, rule.raw_pattern, rule.category_code


def _listed(rules: Rules) -> list[Rule]:
    if isinstance(rules, DataFrame):
        rules = [Rule(*row) for row in _with_priority(rules).toLocalIterator()]
    filled = [r if r.priority is not None else r._replace(priority=DEFAULT_PRIORITY) for r in rules]
    return sorted(filled, key=_rank)


def _with_priority(rules: DataFrame) -> DataFrame:
    priority = F.coalesce("priority", F.lit(DEFAULT_PRIORITY)).alias("priority")
    return rules.select(*[priority if c == "priority" else F.col(c) for c in Rule._fields])


def _applies(remark: Column, rule: Rule) -> Column:
    pattern = rule.raw_pattern
    if not rule.is_regex:
        return remark == pattern.lower()
    if pattern.isascii() and not _REGEX_SIGNS.search(pattern):
        # Plain text needs no regex engine; remarks are lower case already.
        return remark.contains(pattern.lower())
    return remark.rlike(f"(?iu){java_pattern(pattern)}")


def _case(remark: Column, rules: list[Rule], default: str | None) -> Column:
    found = F.lit(default).cast("string")
    if not rules:
        return found
    chain = F.when(_applies(remark, rules[0]), rules[0].category_code)
    for rule in rules[1:]:
        chain = chain.when(_applies(remark, rule), rule.category_code)
    return chain.otherwise(found)


def _first_regex(remark: Column, rules: list[Rule]) -> Column:
    """The best regex rule as (priority, pattern, code); rules are in order.

    Constant patterns, compiled once; chunks keep the expressions short.
    """
    empty = F.lit(None).cast(_FOUND)
    chunks = []
    for start in range(0, len(rules), CHUNK_RULES):
        chain = None
        for rule in rules[start : start + CHUNK_RULES]:
            hit = F.struct(
                F.lit(rule.priority).alias("priority"),
                F.lit(rule.raw_pattern).alias("raw_pattern"),
                F.lit(rule.category_code).alias("category_code"),
            )
            applies = _applies(remark, rule)
            chain = F.when(applies, hit) if chain is None else chain.when(applies, hit)
        chunks.append(chain.otherwise(empty))
    return F.coalesce(*chunks) if chunks else empty


_FOUND = "struct<priority:int,raw_pattern:string,category_code:string>"


def _best_rule_per_remark(df: DataFrame, rules: Rules, remark: str) -> DataFrame:
    """Distinct remarks and the best rule of each: exact ones by join, regex ones by expression."""
    spark = df.sparkSession
    if isinstance(rules, DataFrame):
        table = _with_priority(rules)
        regex = _listed(table.where("is_regex"))
        exact = table.where(~F.coalesce("is_regex", F.lit(False)))
    else:
        listed = _listed(rules)
        regex = [r for r in listed if r.is_regex]
        exact = rules_frame(spark, [r for r in listed if not r.is_regex])
    rank = F.struct("priority", "raw_pattern", "category_code")
    exact = exact.groupBy(F.lower("raw_pattern").alias(remark)).agg(F.min(rank).alias("__exact"))
    found = df.select(remark).distinct().join(exact, remark, "left")
    best = F.least(F.col("__exact").cast(_FOUND), _first_regex(F.col(remark), regex))
    return found.select(remark, best["category_code"].alias("category_code")).where(
        F.col("category_code").isNotNull()
    )


def strategy_for(rules: Rules) -> str:
    """``case`` for as many rules as one expression is the faster form, else ``join``."""
    if isinstance(rules, DataFrame):
        return "case" if rules.limit(CASE_RULES + 1).count() <= CASE_RULES else "join"
    return "case" if len(list(rules)) <= CASE_RULES else "join"


def categorise(
    df: DataFrame,
    rules: Rules,
    remark: str = "remarks",
    default: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Add ``category_code`` to rows with a lower-case remark.

    ``case`` compiles the rules into one expression: no join and no shuffle.
    ``join`` looks up each distinct remark once and joins the answer back, for
    rule tables too long for that: exact rules meet remarks in an equi-join,
    regex rules are expressions. The answers are written when this is called, so
    that measuring and joining them looks nothing up again; df is read once for
    its remarks and once for the result. Both give the same answer for any rules;
    ``auto`` goes by their number.
    """
    if strategy == "auto":
        rules = rules if isinstance(rules, DataFrame) else list(rules)
        strategy = strategy_for(rules)
    if strategy == "case":
        return df.withColumn("category_code", _case(F.col(remark), _listed(rules), default))
    if strategy != "join":
        raise ValueError(f"unknown strategy {strategy!r}")
    best = written(_best_rule_per_remark(df, rules, remark), "rule-of-remark")
    found = lookup_join(df, best, remark, "left")
    if default is not None:
        found = found.withColumn(
            "category_code", F.coalesce("category_code", F.lit(default))
        )
    return found.select(*df.columns, "category_code")


__all__ = [
    "CASE_RULES",
    "REPAYMENT_VARIANTS",
    "RULE_KEYS",
    "RULE_SCHEMA",
    "Rule",
    "Rules",
    "SHIPPED_RULES",
    "UNCATEGORISED",
    "categorise",
    "rules_frame",
    "rules_in_order",
    "strategy_for",
]

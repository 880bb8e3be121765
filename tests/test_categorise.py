import random
import re

import pytest

from cashweave.operators.categorise import (
    REPAYMENT_VARIANTS,
    SHIPPED_RULES,
    Rule,
    categorise,
    rules_frame,
    rules_in_order,
)
from small import rows

CASES = {
    "merchant-repayment": "merchant_repayment",
    " merchant-repayment ": None,
    "transfer to sku": "funds_to_sku",
    "note issued transfer to sku 9": "funds_to_sku",
    "sparkle": "spar",
    "sr interest and sr principal": "sr_int",
    "fh-admin-fee": "admin_fee",
    "acquirer-fee": "mgmt_fee",
    "june management fee": "mgmt_fee",
    "junior-investor-interest": "jr_int",
    "merchant repayment": None,
    "": None,
}


def _remarks(spark, remarks):
    return spark.createDataFrame([(r,) for r in remarks], "remarks string")


@pytest.mark.parametrize("strategy", ["case", "join", "auto"])
def test_shipped_rules(spark, strategy):
    found = categorise(_remarks(spark, CASES), SHIPPED_RULES, strategy=strategy)
    assert dict(rows(found)) == CASES
    named = categorise(
        _remarks(spark, CASES), rules_frame(spark), default="none", strategy=strategy
    )
    assert dict(rows(named)) == {k: v or "none" for k, v in CASES.items()}


def test_more_rules_can_be_added(spark):
    found = categorise(_remarks(spark, ["merchant - repayment x"]), SHIPPED_RULES + REPAYMENT_VARIANTS)
    assert found.first()["category_code"] == "merchant_repayment"


def test_no_rules(spark):
    for strategy in ("case", "join"):
        assert categorise(_remarks(spark, ["x"]), [], strategy=strategy).first()[1] is None


def _best(remark, rules):
    fitting = [
        (r.priority, r.raw_pattern, r.category_code)
        for r in rules
        if (re.search(r.raw_pattern, remark, re.I) if r.is_regex else remark == r.raw_pattern.lower())
    ]
    return min(fitting)[2] if fitting else None


def test_both_forms_agree_with_brute_force(spark):
    dice = random.Random(7)
    words = ["pay", "fee", "sku", "int", "a.b", "a+b"]
    rules = [
        Rule(
            " ".join(dice.choices(["pay", "Fee", "sku", "int"], k=dice.randint(1, 2)))
            + ("\\s*" if dice.random() < 0.3 else ""),
            f"c{i % 9}",
            True,
            dice.randint(1, 4),
        )
        for i in range(25)
    ] + [Rule(w, f"e{w}", False, dice.randint(1, 4)) for w in words]
    remarks = {" ".join(dice.choices(words, k=dice.randint(1, 4))) for _ in range(200)} | {""}
    wanted = {r: _best(r, rules) for r in remarks}
    for strategy in ("case", "join"):
        assert dict(rows(categorise(_remarks(spark, remarks), rules, strategy=strategy))) == wanted


def test_many_rules_with_letters_beyond_ascii(spark):
    """Thousands of rules: one rule more never changes an answer, in either form."""
    dice = random.Random(3)
    words = ["état", "FRAIS", "ünd", "Zinsen", "größe", "pay", "Ärger", "ÇA"]
    rules = [
        Rule(dice.choice(words) + dice.choice(["", r"\s*", " "]) + dice.choice(words), f"c{i % 7}", True, dice.randint(1, 9))
        for i in range(350)
    ] + [Rule(f"{dice.choice(words)} {i}", f"e{i % 5}", False, dice.randint(1, 9)) for i in range(3000)]
    remarks = {" ".join(dice.choices(words, k=3)).lower() for _ in range(60)}
    remarks |= {f"{dice.choice(words)} {i}".lower() for i in range(0, 3000, 50)} | {"état", ""}
    frame = _remarks(spark, remarks)
    few = [r for r in rules if r.is_regex][:290]
    case, join = (dict(rows(categorise(frame, few, strategy=s))) for s in ("case", "join"))
    assert case == join == {r: _best(r, few) for r in remarks}
    wanted = {r: _best(r, rules) for r in remarks}
    assert dict(rows(categorise(frame, rules))) == wanted
    assert dict(rows(categorise(frame, rules_frame(spark, rules)))) == wanted


def test_no_nested_loop(spark, capsys):
    categorise(_remarks(spark, ["x"]), SHIPPED_RULES, strategy="join").explain()
    assert "NestedLoop" not in capsys.readouterr().out


def test_rule_lookup_needs_no_shuffle(spark, capsys):
    categorise(_remarks(spark, ["x"]), SHIPPED_RULES).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan


def test_order_of_the_rule_table(spark):
    first = rules_in_order(rules_frame(spark)).first()
    assert first["raw_pattern"] == "merchant-repayment"
    assert rules_frame(spark).count() == 18


def test_join_reads_the_rows_for_remarks_and_for_the_result_only(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    remarks = spark.range(0, 400, numPartitions=4).selectExpr(
        "if(id % 2 = 0, 'sr interest', concat('other ', id % 7)) AS remarks"
    )
    found = categorise(remarks.mapInArrow(counted, "remarks string"), SHIPPED_RULES, strategy="join")
    assert dict(rows(found.groupBy("category_code").count())) == {"sr_int": 200, None: 200}
    assert seen.value == 800

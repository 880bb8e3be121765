"""Patterns in the database's syntax against what they must find."""

import pytest

from cashweave.functions.patterns import PatternError, java_pattern
from cashweave.operators.categorise import Rule, categorise, rules_frame

# pattern, texts that it finds, texts that it does not.
FOUND = [
    (r"[[:alpha:]]+", ["x", "é1"], ["12", "_"]),
    (r"^[[:digit:]]{2,3}$", ["12", "123"], ["1", "1234", "12\n", "x12"]),
    (r"\mfee\M", ["a fee.", "fee"], ["fees", "coffee"]),
    (r"[[:<:]]fee[[:>:]]", ["a fee."], ["fees", "coffee"]),
    (r"\yint\y", ["int-diff"], ["interest"]),
    (r"\Yint", ["print"], ["int"]),
    (r"[]x]a", ["]a", "xa"], ["ya", "[a"]),
    (r"[^]x]a", ["ya"], ["]a", "xa"]),
    (r"[a[b]c", ["ac", "[c", "bc"], ["dc"]),
    (r"[a&&b]c", ["&c"], ["cc"]),
    (r"[\d\s]z", ["1z", " z"], ["az"]),
    (r"[[:space:][:punct:]]q", [" q", "!q", "$q"], ["aq"]),
    (r"a.c", ["a\nc", "abc"], ["ac"]),
    (r"\Aab\Z", ["ab"], ["ab\n", "xab"]),
    (r"***=a.c", ["xa.cx"], ["abc"]),
    (r"***:a.c", ["abc"], ["ac"]),
    (r"(a|b)\1", ["aa"], ["ab"]),
    (r"xé\x41", ["xéA"], ["xe"]),
    (r"a\.b\[c", ["a.b[c"], ["axb[c"]),
    (r"a\Bb", ["a\\b"], ["ab"]),
    (r"(?:ab)+?c(?=d)(?!dx)", ["ababcd"], ["abcdx", "abc"]),
    (r"a{2}b*?", ["aa"], ["a"]),
]


@pytest.mark.parametrize("form", ["case", "join"])
def test_patterns_find_what_they_say(spark, form):
    for pattern, found, others in FOUND:
        rows = [(t, t in found) for t in found + others]
        df = spark.createDataFrame(rows, "remarks string, wanted boolean")
        done = categorise(df, [Rule(pattern, "hit", True, 1)], strategy=form).collect()
        assert {r["remarks"] for r in done if r["category_code"] == "hit"} == set(found), pattern


@pytest.mark.parametrize("pattern", [r"[[:alfa:]]", r"[[.a.]]", r"[[=a=]]", r"a\q", r"a\c", "a\\", "[ab", "a*+", "a++", r"(?i)a", r"x(?#y)", "***a", r"[\m]", r"\Uffffffff"])
def test_what_java_cannot_say_raises(pattern):
    with pytest.raises(PatternError, match="pattern"):
        java_pattern(pattern)


@pytest.mark.parametrize("form", ["case", "join"])
def test_rules_without_a_priority_come_late(spark, form):
    rules = [Rule("ab", "none", True, None), Rule("a", "late", True, 101), Rule("abc", "first", True, 99), Rule("xyz", "plain", False, None)]
    df = spark.createDataFrame([("abc",), ("ab",), ("a",), ("xyz",)], "remarks string")
    for given in (rules, rules_frame(spark, rules)):
        done = {r["remarks"]: r["category_code"] for r in categorise(df, given, strategy=form).collect()}
        assert done == {"abc": "first", "ab": "none", "a": "late", "xyz": "plain"}

"""Repairs against every sequence of edits, and against a plain program that keeps whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from cashweave.llm import conversations as cv
from cashweave.llm.conversations import Costs, Node, Repair, less

LEGAL = re.compile(r"(s?(ua)+)?")
SHORT = {"s": "system", "u": "user", "a": "assistant"}


def _plain(rows, costs=Costs()):
    """rows: (role, must go, truncated). Best (cost, audit) by strings."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(best, state, value):
        if state not in best or value < best[state]:
            best[state] = value

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                put(best, step[state], (cost + costs.insert, audit + "I"))
        return best

    best = inserts({"": (0, "")})
    for role, must_go, truncated in rows:
        after = {}
        for state, (cost, audit) in best.items():
            put(after, state, (cost + costs.delete, audit + "D"))
            if must_go:
                continue
            stay = cost + (costs.truncated if truncated else 0)
            if role[:1] == step[state] or (role[:1] == "s" and state == ""):
                put(after, role[:1], (stay, audit + "K"))
            put(after, step[state], (stay + costs.rerole, audit + "R"))
        best = inserts(after)
    return min(best[s] for s in ("", "a") if s in best)


def _all_audits(rows, costs, most_inserts=2):
    """Every edit sequence that gives a legal order, with at most so many inserts between rows."""
    from itertools import product

    found = []
    gaps = ["".join(g) for n in range(most_inserts + 1) for g in product("ua", repeat=n)]
    for edits in product("DKua", repeat=len(rows)):
        if any(e != "D" and r[1] for e, r in zip(edits, rows, strict=True)):
            continue
        for put in product(gaps, repeat=len(rows) + 1):
            initials, audit, cost = put[0], "I" * len(put[0]), costs.insert * sum(map(len, put))
            for e, r, g in zip(edits, rows, put[1:], strict=True):
                audit += e if e in "DK" else "R"
                cost += costs.delete if e == "D" else (0 if e == "K" else costs.rerole) + (costs.truncated if r[2] else 0)
                initials += ("" if e == "D" else (r[0][:1] if e == "K" else e)) + g
                audit += "I" * len(g)
            if LEGAL.fullmatch(initials):
                found.append((cost, audit))
    return min(found)


def _repaired(rows, costs=Costs(), open_rows=256):
    repair, edits = Repair(costs, open_rows), []
    for r in rows:
        repair.add(r[:1] + ("text",), r[0][:1], r[1], r[2])
        edits += repair.settled()
    cost, rest = repair.ended()
    return cost, "".join(e for e, *_ in edits + rest), edits + rest


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 9, 1, 1), Costs(3, 3, 2, 0), Costs(1, 1, 1, 1)])
def test_against_all_edits(costs):
    rng = random.Random(7)
    for n in (0, 1, 2, 2, 3, 3):
        rows = [(SHORT.get(c, c), rng.random() < 0.2, rng.random() < 0.3) for c in rng.choices("suax", k=n)]
        assert _repaired(rows, costs)[:2] == _all_audits(rows, costs) == _plain(rows, costs)


@pytest.mark.parametrize("costs", [Costs(), Costs(2, 5, 1, 1), Costs(1, 1, 1, 1), Costs(2, 2, 1, 0)])
@pytest.mark.parametrize("open_rows", [1, 7, 256])
def test_against_strings(costs, open_rows):
    rng = random.Random(open_rows)
    for n in (1, 5, 20, 90, 300):
        for letters in ("suax", "u", "a", "s", "ua", "aau"):
            rows = [(SHORT.get(c, c), rng.random() < 0.1, rng.random() < 0.15) for c in rng.choices(letters, k=n)]
            cost, audit, edits = _repaired(rows, costs, open_rows)
            assert (cost, audit) == _plain(rows, costs)
            assert LEGAL.fullmatch("".join(role[:1] for _, _, role in edits if role is not None))


def test_memory_is_that_of_open_rows():
    """Of a very long conversation few rows are open at a time."""
    repair, most, n = Repair(open_rows=64), 0, 0
    rng = random.Random(1)
    for i in range(30_000):
        role = SHORT[rng.choice("uuaas")]
        repair.add((i, role, "t"), role[0], rng.random() < 0.05, rng.random() < 0.05)
        n += len([e for e in repair.settled() if e[1] is not None])
        most = max(most, len(repair.rows))
    assert n > 29_000 and most < 500


def test_collisions_are_verified(monkeypatch):
    """With one hash for all audits, order is still right."""
    monkeypatch.setattr(cv, "_MODULUS", 1)
    rng = random.Random(2)
    pairs = [("".join(rng.choices("DIKR", k=rng.randint(0, 9))), "".join(rng.choices("DIKR", k=rng.randint(0, 9)))) for _ in range(300)]
    for a, b in pairs:
        nodes, root = [], Node(None, "")
        for edits in (a, b):
            node = root
            for e in edits:
                node = Node(node, e)
            nodes.append(node)
        assert less(*nodes) == (a < b)
    rows = [(SHORT[c], False, False) for c in rng.choices("sua", k=60)]
    assert _repaired(rows)[:2] == _plain(rows)


def _brute(rows):
    """conv_id to the contract's row; rows: (conv_id, turn, role, text) before damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, blank, duplicate, truncated, program = set(), 0, 0, 0, []
        for _, role, text in own:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            again, cut = (role, text) in seen, bool(letters) and letters[-1] not in ".!?"
            seen.add((role, text))
            blank += not letters
            duplicate += bool(letters) and again
            truncated += bool(letters) and not again and cut
            program.append((role, not letters or again, cut))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit = _plain(program)
        repaired, at, last = [], 0, ""
        for e in audit:
            due = "assistant" if last == "u" else "user"
            role, text = (due, "") if e == "I" else own[at][1:]
            at += e != "I"
            if e != "D":
                role = due if e == "R" else role
                repaired.append(f"{role}:{text}")
                last = role[:1]
        sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)
    return out


ODD = [
    (1, 0, "user", "Is it?"), (1, 1, "assistant", "It is."), (1, 1, "assistant", "It is."), (1, None, None, None), (1, 3, "user", "x" * 200_000), (1, 9, "assistant", "Done!"),
    (None, 0, "user", "No id."), (None, None, "tool", "é…"), (None, 2, "assistant", ""), (2, None, None, None), (3, 0, "system", "Only this."),
    (4, 5, "assistant", "Later. \n\t"), (4, -7, "user", "Earlier"), (4, 5, "user", "Later."), (4, 6, "user", "Later."), (5, 1, "", "No role."), (6, 2, "user", "   "), (6, 3, "assistant", "\u0000."),
    *((7, t, "user" if t % 2 else "assistant", "ever the same.") for t in range(50)), *((8, t, SHORT["sua"[t % 3]], f"turn {t}{'.' if t % 4 else ''}") for t in range(400)),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def _found(rows):
    done = rows.collect()
    assert len({r["conv_id"] for r in done}) == len(done)
    return {r["conv_id"]: tuple(r)[1:] for r in done}


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA).repartition(3).withColumn("seen", F.lit("mine")).withColumn("digest", F.lit(1)).withColumn("present", F.lit(False))
    assert _found(cv.audits(cv.damaged(rows))) == _brute(ODD)


def test_query_equals_brute_force(spark):
    done = _found(cv.op11_conversation_repair(spark, "/root/testdata/sf0.01"))
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert done == _brute([tuple(r) for r in rows])


def test_every_row_of_a_conversation_can_be_dropped(spark):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(conv, 0, "user", "Gone.")], SCHEMA)
    assert _found(cv.audits(cv.damaged(rows))) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows(spark):
    """The rows themselves: their texts give the hash, deleted ones have no place."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    whole = {r["conv_id"]: r for r in cv.audits(rows).collect()}
    done = cv.repaired(rows).collect()
    for conv, audit in whole.items():
        own = sorted((r for r in done if r["conv_id"] == conv and r["place"] is not None), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == audit["repaired_sha256"]
        assert sorted(r["edit"] for r in done if r["conv_id"] == conv) == sorted(audit["audit"])


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cv.audits(cv.damaged(none)).collect() == [] == cv.repaired(none).collect()

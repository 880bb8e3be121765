"""Conversation structure repair: the cheapest edits that restore a legal order of roles.

A repaired conversation has role initials ``(s?(ua)+)?``. Every row is kept, given the
role of user or assistant, or deleted, and rows without text may be inserted; of the
cheapest ways the audit, one initial an edit (D, I, K, R), that is least in ASCII counts.
A dynamic program over the rows holds the best audit for each of four states (nothing
kept, after s, after u, after a). Given the state, an edit's role is determined, so an
audit says everything.

Audits of the states share their beginnings, so they are kept as linked nodes: a node
has its edit, its length, a rolling hash of all edits up to it, and ancestors at
distances of powers of two. Two audits of equal cost are compared by their longest
common prefix, found by descending those ancestors while hashes differ; that the prefix
is equal is then verified edit by edit up to the first shared node, so a collision of
hashes costs time only. Two audits of one state over the same rows are never a proper
prefix of one another, since what the longer one has more are inserts, which cost.

States that are dearer than another by more than an insert and a delete can't win and go.
What all remaining audits share is settled: it is applied and forgotten, with its rows.
So a conversation passes its task as a stream, and memory holds the rows that are open,
not the conversation. One stream it must be: its audit is one cell and its repaired text
is one hash. Rows are dealt by conversation and sorted by Spark, and all that needs no
order (faults of a row, the first turn of a text) is found before that, by row, with a
join whose hot keys Spark can split.

Defined cases: rows are taken by turn, null turns first, then by role and text; null
role and text count as one space; a null conv_id is a conversation; repeated rows are
rows, the later ones duplicates; an empty table gives an empty result; columns other
than conv_id, turn, role and text (and `present`, see below) are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import table, unnamed

SPACE = r"\x20\x09-\x0D"
#: Open rows at which a conversation looks for what is settled.
OPEN_ROWS = 256
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: Role initial and state to the state after a row that is kept.
_KEEP = {("s", _EMPTY): _SYSTEM, ("u", _EMPTY): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER, ("a", _USER): _ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_MODULUS, _BASE = (1 << 61) - 1, 0x5BD1E9955BD1E995 % ((1 << 61) - 1)


class Costs(NamedTuple):
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Node:
    """The last edit of an audit; the earlier ones are its ancestors, shared with other audits."""

    __slots__ = ("edit", "length", "hash", "up")

    def __init__(self, parent: Node | None, edit: str):
        self.edit = edit
        if parent is None:
            self.length, self.hash, self.up = 0, 0, ()
            return
        self.length = parent.length + 1
        self.hash = (parent.hash * _BASE + ord(edit)) % _MODULUS
        up, k = [parent], 0
        while k < len(up[k].up):  # the ancestor 2**(k+1) away is 2**k above the one 2**k away
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    @property
    def parent(self) -> Node:
        return self.up[0]

    def lifted(self, length: int) -> Node:
        """The audit's first `length` edits."""
        node, more = self, self.length - length
        while more:
            node = node.up[more.bit_length() - 1]
            more -= 1 << more.bit_length() - 1
        return node

    def edits(self, above: Node | None = None) -> str:
        """The edits after `above` (an ancestor), or all."""
        out, node = [], self
        while node.length and node is not above:
            out.append(node.edit)
            node = node.parent
        return "".join(reversed(out))


def _same(a: Node, b: Node) -> bool:
    """Are two audits of one length equal? Read up to the first shared node."""
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.parent, b.parent
    return True


def less(x: Node, y: Node) -> bool:
    """Is audit x before y in ASCII order?"""
    short = min(x.length, y.length)
    a, b = x.lifted(short), y.lifted(short)
    if a.hash == b.hash and _same(a, b):
        return x.length < y.length
    c, d = a, b
    for k in reversed(range(len(a.up))):
        if k < len(c.up) and c.up[k].hash != d.up[k].hash:
            c, d = c.up[k], d.up[k]
    if c.hash != d.hash and c.edit != d.edit and _same(c.parent, d.parent):
        return c.edit < d.edit
    # A collision: prefixes taken for equal are not. Read all edits instead.
    return a.edits() < b.edits()


def _better(a: tuple[int, Node] | None, b: tuple[int, Node]) -> tuple[int, Node]:
    if a is None or b[0] < a[0] or (b[0] == a[0] and b[1] is not a[1] and less(b[1], a[1])):
        return b
    return a


class Repair:
    """The edits of one conversation, row by row. settled() gives rows as they become certain."""

    def __init__(self, costs: Costs = Costs(), open_rows: int = OPEN_ROWS):
        if costs.insert <= 0:
            raise ValueError("an insert must cost something")
        self.costs, self.open_rows = costs, open_rows
        self.root = Node(None, "")
        self.best: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.rows: list[tuple] = []
        self.state, self.look = _EMPTY, open_rows
        self._inserted()

    def _inserted(self) -> None:
        """Rows put in here; two in a row reach every state that inserts can."""
        for into, sources in ((_USER, (_EMPTY, _SYSTEM, _ASSISTANT)), (_ASSISTANT, (_USER,))):
            for state in sources:
                if (had := self.best[state]) is not None:
                    cost, now = had[0] + self.costs.insert, self.best[into]
                    if now is None or cost <= now[0]:
                        self.best[into] = _better(now, (cost, Node(had[1], "I")))
        most = min(self.best[s][0] for s in (_USER, _ASSISTANT)) + self.costs.insert + self.costs.delete
        self.best = [b if b is not None and b[0] <= most else None for b in self.best]

    def add(self, row: tuple, initial: str, must_go: bool, truncated: bool) -> None:
        """row: whatever settled() shall give back, role and text last."""
        self.rows.append(row)
        after: list[tuple[int, Node] | None] = [None] * 4

        def reach(state: int, cost: int, node: Node, edit: str) -> None:
            now = after[state]
            if now is None or cost <= now[0]:
                after[state] = _better(now, (cost, Node(node, edit)))

        stay = self.costs.truncated if truncated else 0
        for state, had in enumerate(self.best):
            if had is None:
                continue
            cost, node = had
            reach(state, cost + self.costs.delete, node, "D")
            if not must_go:
                kept = _KEEP.get((initial, state))
                if kept is not None:
                    reach(kept, cost + stay, node, "K")
                if kept != _NEXT[state]:
                    reach(_NEXT[state], cost + stay + self.costs.rerole, node, "R")
        self.best = after
        self._inserted()

    def _apply(self, edits: str) -> Iterator[tuple[str, tuple | None, str | None]]:
        """(edit, row, role it gets); the row is None for an insert, the role for a delete."""
        taken = 0
        for edit in edits:
            if edit == "I":
                self.state = _NEXT[self.state]
                yield edit, None, _ROLE[self.state]
                continue
            row = self.rows[taken]
            taken += 1
            if edit == "D":
                yield edit, row, None
            elif edit == "K":
                self.state = _KEEP[row[-2][:1], self.state]
                yield edit, row, row[-2]
            else:
                self.state = _NEXT[self.state]
                yield edit, row, _ROLE[self.state]
        del self.rows[:taken]

    def settled(self) -> list[tuple[str, tuple | None, str | None]]:
        """Edits that all remaining audits have in common, looked for now and then."""
        if len(self.rows) < self.look:
            return []
        live = list({id(b[1]): b[1] for b in self.best if b is not None}.values())
        shared = live[0]
        for node in live[1:]:
            while shared is not node:
                if shared.length >= node.length:
                    shared = shared.parent
                else:
                    node = node.parent
        out = list(self._apply(shared.edits()))
        # What is open begins anew below the shared node.
        made = {id(shared): Node(None, "")}

        def anew(node: Node) -> Node:
            chain = []
            while id(node) not in made:
                chain.append(node)
                node = node.parent
            for own in reversed(chain):
                made[id(own)] = Node(made[id(own.parent)], own.edit)
            return made[id(chain[0])] if chain else made[id(node)]

        self.best = [None if b is None else (b[0], anew(b[1])) for b in self.best]
        self.look = len(self.rows) + self.open_rows
        return out

    def ended(self) -> tuple[int, list[tuple[str, tuple | None, str | None]]]:
        """The cost, and the edits that were still open."""
        best = None
        for state in (_EMPTY, _ASSISTANT):
            if self.best[state] is not None:
                best = _better(best, self.best[state])
        return best[0], list(self._apply(best[1].edits()))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and present; whether the text is blank or truncated, and
    whether the conversation has the same role and text at an earlier turn.

    rows: conv_id, turn, role, text. If there is a column `present`, rows where it is not
    true are not there, but their conversation is.
    """
    present = F.coalesce("present", F.lit(False)) if "present" in rows.columns else F.lit(True)
    filled = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
        present.alias("present"),
    )
    said = filled.withColumn("digest", F.unhex(F.sha2("text", 256)))
    key = ["conv_id", "role", "digest"]
    # A struct, because null turns come first.
    first = said.where("present").groupBy(*key).agg(F.min(F.struct("turn")).alias("first")).toDF("c", "r", "d", "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return said.join(first, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "present",
        F.col("text").rlike(f"[^{SPACE}]").alias("said"),
        F.col("text").rlike(rf"[.!?][{SPACE}]*\z").alias("closed"),
        F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("seen"),
    )


_READ = ["conv_id", "turn", "role", "text", "present", "said", "closed", "seen"]
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
AUDITS = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"


class _Conversation:
    """Counts and edits of one conversation as its rows come by."""

    def __init__(self, conv_id: int | None, costs: Costs):
        self.conv_id, self.repair = conv_id, Repair(costs)
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.audit, self.hash, self.written, self.place = [], hashlib.sha256(), False, 0
        self.before = None
        self.least = self.turn = None
        self.turns = 0

    def add(self, turn, role, text, said, closed, seen) -> list[tuple]:
        again = seen or self.before == (turn, role, text)
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.least, self.turn = turn if self.least is None else self.least, turn
        if self.before is not None and self.before[1][:1] + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        self.before = (turn, role, text)
        fault = "blank" if not said else "duplicate" if again else "truncated" if not closed else None
        if fault:
            self.counts[fault] += 1
        self.repair.add((turn, role, text), role[:1], not said or again, said and not closed)
        return self._took(self.repair.settled())

    def _took(self, edits: list[tuple]) -> list[tuple]:
        """Rows of the repaired conversation; deleted ones stand among them without a place."""
        out = []
        for edit, row, role in edits:
            self.audit.append(edit)
            turn, own, text = row or (None, role, "")
            if role is not None:
                self.hash.update(f"{'\n' if self.written else ''}{role}:{text}".encode())
                self.written = True
            out.append((self.conv_id, None if role is None else self.place, edit, turn, own if role is None else role, text))
            self.place += role is not None
        if len(self.audit) > 1000:
            self.audit = ["".join(self.audit)]
        return out

    def end(self) -> tuple[tuple, list[tuple]]:
        self.counts["cost"], edits = self.repair.ended()
        rows = self._took(edits)
        if self.turns:
            self.counts["gaps"] = self.turn - self.least + 1 - self.turns
        return (self.conv_id, *self.counts.values(), "".join(self.audit), self.hash.hexdigest()), rows


def _passed(costs: Costs, audits: bool):
    """Sorted rows to audits, one a conversation, or to the rows of the repaired conversations."""
    names = [f.split()[0] for f in (AUDITS if audits else REPAIRED).split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in (AUDITS if audits else REPAIRED).split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv_id, turn, role, text, present, said, closed, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        whole, rows = now.end()
                        out += [whole] if audits else rows
                    now = _Conversation(conv_id, costs)
                if present:
                    rows = now.add(turn, role, text, said, closed, seen)
                    if not audits:
                        out += rows
            yield batch_of(out)
        if now is not None:
            whole, rows = now.end()
            yield batch_of([whole] if audits else rows)

    return run


def _in_order(rows: DataFrame) -> DataFrame:
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn")]
    return faults(rows).select(*_READ).repartition("conv_id").sortWithinPartitions(*order, "role", "text")


def audits(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row a conversation: conv_id, counts of faults, cost, audit and hash of the repaired text."""
    return _in_order(rows).mapInArrow(_passed(costs, True), AUDITS)


def repaired(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The rows of the repaired conversations, with their place from 0 on, and deleted ones without a place."""
    return _in_order(rows).mapInArrow(_passed(costs, False), REPAIRED)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as the audit's contract damages them, by crc32 of `conv_id:turn` modulo 20."""
    filled = unnamed(conversations, "conv_id", "turn", "role", "text").select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    marked = filled.withColumn("kind", F.crc32(name) % 20)
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(True), F.when(kind == 3, 2).otherwise(1)))
    rows = marked.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind != 0).alias("present"), copies.alias("copy"))
    return rows.drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(table(spark, sf_dir, "conversations")))

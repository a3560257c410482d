"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``: an optional system turn, then pairs of user and assistant
turns, or nothing at all. Repair keeps, re-roles, deletes and inserts rows
at least cost.

The search is a weighted hypergraph of deductions. Its items are

* ``("row", i)``: row i as it is, an axiom of weight (0, "");
* ``(i, state)``: the first i rows are repaired and what stands so far left
  the pattern in ``state``; ``(0, START)`` is an axiom;
* the goal: all rows are repaired and the pattern may end.

A deduction has the item before it and, if it reads a row, that row as
premises; its weight function adds the premises' costs and its own, joins
their audits and appends the initial of the edit. Weights are ordered by
(cost, audit). The function is monotone and superior (no conclusion is lighter
than a premise: its cost is not less, and its audit begins with the audit
of the one premise that has any), so that items leave the agenda in the order
of their weights and the first weight of an item that leaves is its least.
The search ends when the goal leaves the agenda.

Rows stream through their task sorted by conversation and turn. A long
conversation is searched ``CHUNK`` rows at a time: the items after the last
row of a chunk are the axioms of the next one, what their audits have in
common is settled, applied and hashed, and only what they do not share is
held. A task so holds the rows of a chunk, 16 bytes for each different row
of the one conversation it is at, and its audit. The hash of a
conversation's text is a chain over its rows in order and has no parallel
form; conversations are the unit that is dealt out.

Defined cases: a null ``role`` or ``text`` counts as one space (a role that
fits no symbol: re-roled or deleted; a blank text: deleted), and so does a
null ``conv_id`` or ``turn`` in the key of the damage. Null ``conv_id`` rows
are one conversation. Rows of one turn are ordered by role and text.
Repeated rows are duplicates, found as such. A conversation that has no rows
gives zeros, an empty audit and the hash of the empty string. An empty table
gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# states of the pattern, and the state that a symbol leads to
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
MAY_END = (START, ASSISTANT)
GOAL = "goal"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping a row costs nothing
ROLES = {"u": "user", "a": "assistant"}
SOUND, BLANK, DUPLICATE, CUT = "sound", "blank", "duplicate", "truncated"
LEGAL_PAIRS = {"su", "ua", "au"}
CHUNK = 256
SHORT = 32


# -- the agenda ------------------------------------------------------------------

def lightest_derivations(axioms: dict, deductions: list[tuple], goals: set) -> dict:
    """Knuth's algorithm. ``axioms``: item to (cost, audit); ``deductions``:
    (premises, conclusion, cost, initial). Returns the least weight of each
    goal that can be derived; ends when all of them have left the agenda."""
    uses: dict = {}
    missing = []
    for e, (premises, *_) in enumerate(deductions):
        missing.append(len(premises))
        for p in premises:
            uses.setdefault(p, []).append(e)
    agenda = [(cost, audit, str(item), item) for item, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: dict = {}
    open_goals = set(goals)
    while agenda and open_goals:
        cost, audit, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        open_goals.discard(item)
        for e in uses.get(item, ()):
            missing[e] -= 1
            if missing[e]:
                continue
            premises, conclusion, own, initial = deductions[e]
            if conclusion not in final:
                weights = [final[p] for p in premises]
                heapq.heappush(agenda, (sum(w[0] for w in weights) + own, "".join(w[1] for w in weights) + initial, str(conclusion), conclusion))
    return {g: final[g] for g in goals if g in final}


def deductions_of(rows: list[tuple[str, str]], first: int = 0, to_goal: bool = True) -> list[tuple]:
    """The deductions over ``rows`` (initial, fault), numbered from ``first``."""
    out = []
    for i in range(first, first + len(rows) + 1):
        for (state, symbol), after in STEP.items():
            if symbol in ROLES:
                out.append((((i, state),), (i, after), INSERT, "I"))
    for i, (initial, fault) in enumerate(rows, first):
        extra = TRUNCATED if fault == CUT else 0
        for state in range(4):
            premises = ((i, state), ("row", i))
            out.append((premises, (i + 1, state), DELETE, "D"))
            if fault in (BLANK, DUPLICATE):
                continue
            if (state, initial) in STEP:
                out.append((premises, (i + 1, STEP[state, initial]), extra, "K"))
            for symbol in ROLES:
                if (state, symbol) in STEP:
                    out.append((premises, (i + 1, STEP[state, symbol]), REROLE + extra, "R"))
    if to_goal:
        out += [(((first + len(rows), state),), GOAL, 0, "") for state in MAY_END]
    return out


@lru_cache(maxsize=1 << 16)
def lightest_repair(rows: tuple[tuple[str, str], ...]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation given as (initial, fault) rows."""
    axioms = {("row", i): (0, "") for i in range(len(rows))} | {(0, START): (0, "")}
    return lightest_derivations(axioms, deductions_of(rows), {GOAL})[GOAL]


def _shared_prefix(texts: list[str]) -> int:
    low, high = min(texts), max(texts)
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), len(low))


# -- one conversation, row by row --------------------------------------------------

def _last_visible(text: str) -> str | None:
    bare = text.rstrip(" \t\n\x0b\x0c\r")
    return bare[-1] if bare else None


class Conversation:
    """Takes the damaged rows of one conversation in order; ``result`` is its repair."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = dict.fromkeys((BLANK, DUPLICATE, CUT), 0)
        self.illegal, self.last_initial = 0, None
        self.least = self.most = self.last_turn = None
        self.turns = 0
        self.seen: set[bytes] = set()
        self.rows, self.pending = [], []  # not searched; searched, edit not settled
        self.number = 0
        self.front = {START: (0, "")}  # weight of each state after the rows searched
        self.settled: list[str] = []
        self.state, self.digest, self.lines = START, hashlib.sha256(), 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = self.last_turn = turn
        initial, end = role[:1], _last_visible(text)
        if self.last_initial is not None and self.last_initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.last_initial = initial
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if end is None:
            fault = BLANK
        elif key in self.seen:
            fault = DUPLICATE
        else:
            fault = SOUND if end in ".!?" else CUT
        self.seen.add(key)
        if fault != SOUND:
            self.counts[fault] += 1
        self.rows.append((role, text, (initial if initial in ("s", "u", "a") else "", fault)))
        if len(self.rows) >= CHUNK:
            self._search()

    def _search(self) -> None:
        """Settle what all ways to go on from this chunk have in common."""
        first, last = self.number, self.number + len(self.rows)
        axioms = {("row", i): (0, "") for i in range(first, last)} | {(first, s): w for s, w in self.front.items()}
        marks = [m for *_, m in self.rows]
        found = lightest_derivations(axioms, deductions_of(marks, first, to_goal=False), {(last, s) for s in range(4)})
        self.front = {s: w for (_, s), w in found.items() if not self._hopeless(s, w[0], found.get((last, ASSISTANT)))}
        self.number = last
        self.pending += [(role, text) for role, text, _ in self.rows]
        self.rows = []
        n = _shared_prefix([a for _, a in self.front.values()])
        self._settle(next(iter(self.front.values()))[1][:n])
        self.front = {s: (c, a[n:]) for s, (c, a) in self.front.items()}

    @staticmethod
    def _hopeless(state: int, cost: int, ended: tuple | None) -> bool:
        """Whether every way on from ``state`` costs more than one on from
        ASSISTANT: what follows a system turn may follow an assistant's, and
        what follows the start too, once a system turn is deleted."""
        return ended is not None and (state == SYSTEM and cost > ended[0] or state == START and cost > ended[0] + DELETE)

    def _settle(self, audit: str) -> None:
        """Apply these edits to the rows that wait for them."""
        at = 0
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            symbol = "a" if self.state == USER else "u"
            if edit == "I":
                line = f"{ROLES[symbol]}:"
            else:
                role, text = self.pending[at]
                at += 1
                if edit == "K":
                    symbol = role[:1]
                line = f"{role if edit == 'K' else ROLES[symbol]}:{text}"
            self.digest.update(("\n" if self.lines else "").encode() + line.encode())
            self.lines += 1
            self.state = STEP[self.state, symbol]
        del self.pending[:at]
        self.settled.append(audit)

    def result(self) -> tuple:
        if self.number == 0 and len(self.rows) <= SHORT:  # nearly all: equal patterns are searched once
            cost, audit = lightest_repair(tuple(m for *_, m in self.rows))
        else:
            first, last = self.number, self.number + len(self.rows)
            axioms = {("row", i): (0, "") for i in range(first, last)} | {(first, s): w for s, w in self.front.items()}
            cost, audit = lightest_derivations(axioms, deductions_of([m for *_, m in self.rows], first), {GOAL})[GOAL]
        self.pending += [(role, text) for role, text, _ in self.rows]
        self._settle(audit)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, cost,
                "".join(self.settled), self.digest.hexdigest())


# -- Spark -------------------------------------------------------------------------

def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that a row's key asks for,
    and ``gone`` for rows that were dropped (they keep their conversation)."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    text = _or_space("text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_or_space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """The report of each conversation of ``rows`` (conv_id, turn, role, text, gone)."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in RESULT.split(", ")]
        now, out = None, []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for b in batches:
            for at in range(0, b.num_rows, 512):  # so many rows at once are Python objects
                part = b.slice(at, 512)
                for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in part.columns)):
                    if now is None or conv_id != now.conv_id:
                        if now is not None:
                            out.append(now.result())
                        now = Conversation(conv_id)
                    if not gone:
                        now.add(turn, role, text)
            if len(out) >= 2048:
                yield batch()
                out = []
        if now is not None:
            out.append(now.result())
        if out:
            yield batch()

    dealt = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, RESULT)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage and repair of every conversation."""
    return repair(damage(conversations))

"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``, with an audit.

Each row is kept (K), given another role (R) or deleted (D), and empty turns may be inserted (I). A dynamic program goes
over the rows once; its states say what may come next. Every state holds the best edits so far as a node of a persistent
list: edits share their prefixes, so a row costs a few nodes whatever went before. Of equally cheap edits the one that is
least in ASCII wins; two lists are compared by the longest common prefix of their nodes, found with binary-lifting
ancestors and rolling hashes, and what the hashes call equal is verified back to where the lists part or were verified
before.

In Spark the rows are shuffled once by conversation, sorted, and streamed through Arrow batches. What all live states
share is settled: it is put out and forgotten, so a task holds a stretch of edits and texts, not a conversation. States
that can no longer win are dropped, which keeps that stretch short.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What counts as blank, and what ends a whole text.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"

# Pairs of role initials that may follow each other.
LEGAL = frozenset(("su", "ua", "au"))

# States: nothing yet, a system turn, an open user turn, a closed exchange; which initial leads where.
START, SYSTEM, OPEN, CLOSED = range(4)
FOLLOWS = {"s": {START: SYSTEM}, "u": {START: OPEN, SYSTEM: OPEN, CLOSED: OPEN}, "a": {OPEN: CLOSED}}
# The turn that a rerole or an insert makes in each state, and the state after it.
MAKES = {START: ("user", OPEN), SYSTEM: ("user", OPEN), OPEN: ("assistant", CLOSED), CLOSED: ("user", OPEN)}
FINAL = (START, CLOSED)


@dataclass(frozen=True)
class Costs:
    """Costs of the edits; ``truncated`` is added for a truncated row that stays. All but ``rerole`` and ``truncated`` are
    above 0."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def slack(self) -> dict[tuple[int, int], int]:
        """(t, s) -> the most that finishing from t can cost more than finishing from s in the same way."""
        d, i = self.delete, self.insert
        to_start = {SYSTEM: 2 * i + d, OPEN: i + d, CLOSED: d}
        to_system = {START: 0, OPEN: i, CLOSED: 0}
        to_open = {START: i, SYSTEM: i, CLOSED: i}
        to_closed = {START: 0, SYSTEM: 2 * i, OPEN: i}
        every = ((START, to_start), (SYSTEM, to_system), (OPEN, to_open), (CLOSED, to_closed))
        return {(t, s): x for s, froms in every for t, x in froms.items()}


class Audits:
    """Edit strings as linked nodes. A node adds a run of one letter to its parent; node 0 is the empty string."""

    PRIME, BASE = (1 << 61) - 1, 1_000_003

    def __init__(self) -> None:
        self.parent, self.letter, self.length, self.hash, self.up = [0], [""], [0], [0], [[]]
        self.verified: set[tuple[int, int]] = set()

    def __len__(self) -> int:
        return len(self.parent)

    def _extend(self, value: int, letter: str, times: int) -> int:
        """The hash after ``times`` more of ``letter``: a geometric series."""
        if times == 1:
            return (value * self.BASE + ord(letter)) % self.PRIME
        power = pow(self.BASE, times, self.PRIME)
        series = (power - 1) * pow(self.BASE - 1, -1, self.PRIME)
        return (value * power + ord(letter) * series) % self.PRIME

    def add(self, parent: int, letter: str, times: int = 1) -> int:
        node, up = len(self.parent), [parent]
        while True:  # the ancestor twice as far up is the same step from the ancestor
            further = self.up[up[-1]]
            if len(further) < len(up):
                break
            up.append(further[len(up) - 1])
        self.parent.append(parent)
        self.letter.append(letter)
        self.length.append(self.length[parent] + times)
        self.hash.append(self._extend(self.hash[parent], letter, times))
        self.up.append(up)
        return node

    def covering(self, node: int, at: int) -> int:
        """The node of this string that holds the letter at place ``at``."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            if k < len(self.up[node]) and self.length[self.up[node][k]] > at:
                node = self.up[node][k]
        return node

    def prefix_hash(self, node: int, length: int) -> int:
        if not length:
            return 0
        node = self.covering(node, length - 1)
        above = self.parent[node]
        return self._extend(self.hash[above], self.letter[node], length - self.length[above])

    def common(self, x: int, y: int) -> int:
        """Length of the longest common prefix, as far as hashes tell."""

        def agrees(node: int) -> bool:
            n = self.length[node]
            return n <= self.length[y] and self.prefix_hash(y, n) == self.hash[node]

        if agrees(x):
            return self.length[x]
        node = x
        for k in range(len(self.up[node]) - 1, -1, -1):
            if k < len(self.up[node]) and not agrees(self.up[node][k]):
                node = self.up[node][k]
        at = self.length[self.parent[node]]  # the strings part inside the run of this node
        while at < min(self.length[node], self.length[y]):
            other = self.covering(y, at)
            if self.letter[other] != self.letter[node]:
                break
            at = min(self.length[node], self.length[other])
        return at

    def equal(self, x: int, y: int, length: int) -> bool:
        """Whether the first ``length`` letters agree, letter by letter, back to a shared node or a verified pair."""
        if not length:
            return True
        a, b, at = self.covering(x, length - 1), self.covering(y, length - 1), length
        first = (a, b)
        while at and a != b:
            if self.letter[a] != self.letter[b]:
                return False
            if at == self.length[a] == self.length[b] and (a, b) in self.verified:
                break
            above = self.length[self.parent[a]], self.length[self.parent[b]]
            at = max(above)
            a = self.parent[a] if above[0] == at else a
            b = self.parent[b] if above[1] == at else b
        if length == self.length[first[0]] == self.length[first[1]]:
            self.verified.add(first)
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether the string of x is before that of y in ASCII."""
        if x == y:
            return False
        at = self.common(x, y)
        if not self.equal(x, y, at):  # equal hashes of different strings
            return self.text(x) < self.text(y)
        if at in (self.length[x], self.length[y]):
            return self.length[x] < self.length[y]
        return self.letter[self.covering(x, at)] < self.letter[self.covering(y, at)]

    def path(self, node: int) -> list[int]:
        """The nodes from below the root to ``node``."""
        out = []
        while node:
            out.append(node)
            node = self.parent[node]
        return out[::-1]

    def run(self, node: int) -> str:
        return self.letter[node] * (self.length[node] - self.length[self.parent[node]])

    def text(self, node: int) -> str:
        return "".join(self.run(n) for n in self.path(node))


Edit = Callable[[str, int | None, str, str], None]


class Repair:
    """The repair of one conversation, row by row. ``edit(letter, turn, role, text)`` is called for every edit, in order, as
    soon as it is settled: at the latest with ``finish``, and whenever ``room`` nodes or characters are waiting."""

    def __init__(self, edit: Edit, costs: Costs = Costs(), room: int = 4096, characters: int = 4_000_000) -> None:
        self.edit, self.costs, self.room, self.characters = edit, costs, room, characters
        self.slack, self.audits = costs.slack(), Audits()
        self.limit, self.forced, self.state, self.spent = room, 0, START, 0
        self.waiting: deque[tuple[int | None, str, str]] = deque()
        self.size = self.settled_at = 0
        self.live = {START: (0, 0)}
        self._insert()

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        """The next row; ``fault`` is its first fault: blank, duplicate, truncated or none."""
        self.waiting.append((turn, role, text))
        self.size += len(role) + len(text)
        if fault in ("blank", "duplicate"):
            self.forced += 1  # a run of such rows is one run of deletions in every state
        else:
            self._run()
            self._row(role[:1], fault == "truncated")
        if len(self.audits) > self.limit or (self.size - self.settled_at > self.characters and len(self.audits) > 64):
            self._settle()

    def finish(self) -> int:
        """Settles the rest; returns the cost."""
        self._run()
        cost, node = self._least([self.live[s] for s in FINAL if s in self.live])
        self._put_out(self.audits.path(node))
        return cost

    def _least(self, found: list[tuple[int, int]]) -> tuple[int, int]:
        best = found[0]
        for cost, node in found[1:]:
            if cost < best[0] or cost == best[0] and self.audits.less(node, best[1]):
                best = cost, node
        return best

    def _advance(self, steps: list[tuple[int, int, int, str, int]]) -> dict[int, tuple[int, int]]:
        """The best of the given steps (state reached, cost, node before, letter, times) for each state."""
        cheapest: dict[int, int] = {}
        for state, cost, *_ in steps:
            cheapest[state] = min(cost, cheapest.get(state, cost))
        found: dict[int, list[tuple[int, int]]] = {}
        for state, cost, node, letter, times in steps:
            if cost == cheapest[state]:
                found.setdefault(state, []).append((cost, self.audits.add(node, letter, times) if letter else node))
        return {state: self._least(ways) for state, ways in found.items()}

    def _run(self) -> None:
        if self.forced:
            n, self.forced = self.forced, 0
            steps = [(s, cost + n * self.costs.delete, node, "D", n) for s, (cost, node) in self.live.items()]
            self.live = self._advance(steps)
            self._insert()

    def _row(self, initial: str, truncated: bool) -> None:
        stays = self.costs.truncated if truncated else 0
        follows, steps = FOLLOWS.get(initial, {}), []
        for s, (cost, node) in self.live.items():
            steps.append((s, cost + self.costs.delete, node, "D", 1))
            if s in follows:
                steps.append((follows[s], cost + stays, node, "K", 1))
            steps.append((MAKES[s][1], cost + self.costs.rerole + stays, node, "R", 1))
        self.live = self._advance(steps)
        self._insert()

    def _insert(self) -> None:
        """Inserts after the last row: two at most, for two lead from any state to any that can be reached at all. States
        that cannot win any more are dropped."""
        for _ in range(2):
            steps = [(s, cost, node, "", 0) for s, (cost, node) in self.live.items()]
            steps += [(MAKES[s][1], cost + self.costs.insert, node, "I", 1) for s, (cost, node) in self.live.items()]
            self.live = self._advance(steps)
        low = {s: cost for s, (cost, _) in self.live.items()}
        for s in list(self.live):
            if any(t != s and low[s] > cost + self.slack[t, s] for t, cost in low.items()):
                del self.live[s]

    def _settle(self) -> None:
        """Puts out the edits that all live states share and begins a new list of nodes after them."""
        self._run()
        paths = [self.audits.path(node) for _, node in self.live.values()]
        shared = 0
        for nodes in zip(*paths):
            if len(set(nodes)) > 1:
                break
            shared += 1
        self._put_out(paths[0][:shared])
        old, self.audits, new = self.audits, Audits(), {}
        for path in paths:
            for node in path[shared:]:
                if node not in new:
                    times = old.length[node] - old.length[old.parent[node]]
                    new[node] = self.audits.add(new.get(old.parent[node], 0), old.letter[node], times)
        self.live = {s: (cost, new.get(node, 0)) for s, (cost, node) in self.live.items()}
        self.limit = max(self.room, 2 * len(self.audits))
        self.settled_at = self.size

    def _put_out(self, path: list[int]) -> None:
        for node in path:
            for letter in self.audits.run(node):
                made, after = MAKES[self.state]
                if letter == "I":
                    self.edit("I", None, made, "")
                    self.state = after
                    continue
                turn, role, text = self.waiting.popleft()
                if letter == "K":
                    self.state = FOLLOWS[role[:1]][self.state]
                elif letter == "R":
                    role, self.state = made, after
                self.edit(letter, turn, role, text)


def _streamed(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows ``conv, turn, role, text, fault`` of whole conversations side by side, in order: one shuffle."""
    named = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )
    whole = F.rtrim("text", F.lit(BLANKS))
    named = named.withColumns({"same": F.sha2(F.concat_ws("\n", F.sha2("role", 256), F.sha2("text", 256)), 256), "last": F.right(whole, F.lit(1))})
    order = [F.col("turn").asc_nulls_first(), "role", "same"]
    # A conversation is on one partition already, so this window brings no shuffle of its own.
    seen = F.row_number().over(Window.partitionBy("conv", "same").orderBy(*order))
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.col("last").isin(*ENDS), "truncated")
    )
    rows = named.repartition("conv").withColumn("seen", seen).withColumn("fault", fault)
    return rows.sortWithinPartitions("conv", *order, "seen").select("conv", "turn", "role", "text", "fault")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, room: int = 2_000, characters: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= room or size >= characters:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per edit: the conversation, ``place`` (0, 1, ...), ``edit`` (K, R, D or I), ``turn`` (null for an insert),
    ``role`` and ``text``: the turn as it stands after the edit, or what a D took away.

    Rows of a conversation are taken by turn, null turns first, equal turns by role and then by a digest of the text. A null
    role or text is one space. A row is blank without a character that is not blank; a duplicate if its role and text came
    before; truncated if its last such character does not end a sentence; the first of these that holds counts. Null
    conversation ids form one conversation. No rows give no rows; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            repair, current, out = None, None, []
            place = 0
            for conv, turn, role, text, fault in _rows(batches):
                if repair is None or conv != current:
                    if repair:
                        repair.finish()
                    for edit in out:
                        yield (current, place, *edit)
                        place += 1
                    out.clear()
                    repair, current, place = Repair(lambda *e: out.append(e), costs), conv, 0
                repair.add(turn, role, text, fault)
                for edit in out:
                    yield (current, place, *edit)
                    place += 1
                out.clear()
            if repair:
                repair.finish()
                for edit in out:
                    yield (current, place, *edit)
                    place += 1

        yield from _batches(edits(), schema)

    rows = _streamed(turns, conv_col, turn_col, role_col, text_col)
    out = f"conv {rows.schema['conv'].dataType.simpleString()}, place long, edit string, turn long, role string, text string"
    schema = _arrow(rows, out)
    return rows.mapInArrow(run, out).withColumnRenamed("conv", conv_col)


def _arrow(rows: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class _Report:
    """Figures of one conversation, and the digest of its repaired turns, updated edit by edit."""

    def __init__(self, costs: Costs) -> None:
        self.repair, self.digest, self.audit, self.any = Repair(self._edit, costs), hashlib.sha256(), [], False
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.distinct = 0

    def _edit(self, letter: str, turn: int | None, role: str, text: str) -> None:
        self.audit.append(letter)
        if len(self.audit) > 65_536:
            self.audit = ["".join(self.audit)]
        if letter != "D":
            self.digest.update(f"{'\n' if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if turn is not None and turn != self.high:  # in order, so a turn is new when it is not the last one
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        self.repair.add(turn, role, text, fault)

    def row(self) -> tuple:
        cost = self.repair.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.digest.hexdigest())


def repair_report(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per conversation: ``gaps`` (turn numbers missing between its least and its greatest), ``blank``,
    ``duplicate``, ``truncated`` (rows by first fault), ``illegal`` (neighbours whose roles may not follow each other),
    ``cost``, ``audit`` (the edits in order) and ``repaired_sha256`` (of the repaired ``role:text``, joined by line breaks).

    Rows are read as ``repaired_turns`` reads them, which puts out the turns themselves. A digest is a chain over all text of
    a conversation, so one task streams it; the stretch of edits that is not settled, and the audit, are what it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports() -> Iterator[tuple]:
            report, current = None, None
            for conv, *row in _rows(batches):
                if report is None or conv != current:
                    if report:
                        yield (current, *report.row())
                    report, current = _Report(costs), conv
                report.add(*row)
            if report:
                yield (current, *report.row())

        yield from _batches(reports(), schema)

    rows = _streamed(turns, conv_col, turn_col, role_col, text_col)
    counts = ", ".join(f"{n} long" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    out = f"conv {rows.schema['conv'].dataType.simpleString()}, {counts}, audit string, repaired_sha256 string"
    schema = _arrow(rows, out)
    return rows.mapInArrow(run, out).withColumnRenamed("conv", conv_col)

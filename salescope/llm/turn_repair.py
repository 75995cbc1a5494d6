"""Conversation structure repair by secondary-sorted streaming.

The messages are repartitioned by conversation and sorted by turn, and one
pass over the Arrow batches of a partition finds the cheapest edits that give
every conversation the roles ``(s?(ua)+)?``: keep, rerole, delete, insert.

Four states (nothing yet, after a system, a user, an assistant turn) are all
that a conversation carries from row to row: of each, the cost and the place
in the order of the edit strings of its cheapest path, and the running hash of
the messages that path keeps.  No text is held.  Costs are kept relative to
the least, so the states' vectors recur: each vector and kind of row is solved
once and then looked up, and a row leaves behind the number of its solution
alone, from which the edits are read backwards at the end of the conversation.
These backpointers go to an unnamed scratch file of the task beyond
``_HELD`` rows; the system frees it with the task, which if lost runs anew.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits; a truncated message that stays adds the last.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Next state by role initial; states: 0 nothing, 1 system, 2 user, 3 assistant.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ENDS = (0, 3)
_ROLE = {2: "user", 3: "assistant"}
#: The only user or assistant turn that may follow each state.
_GROWN = (2, 2, 3, 2)
#: Backpointers of a conversation that stay in memory.
_HELD = 1 << 20

#: Result columns after conv_id.
RESULT = {
    "gaps": "long",
    "blank": "long",
    "duplicate": "long",
    "truncated": "long",
    "illegal": "long",
    "cost": "long",
    "audit": "string",
    "repaired_sha256": "string",
}


class Solver:
    """Solved steps: of a vector of states and a kind of row, the next vector
    and the path to each of its states.

    A vector holds for each state None or ``(cost above the least, rank)``; the
    ranks order the edit strings.  No two strings of one vector are prefixes of
    each other: each but the first vector's ends with an edit that takes the
    row, and strings of the same origin differ in it or the insertions before.
    """

    START = ((0, 0), None, None, None)

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        #: (next vector, cost added, per state (origin, insertions, letter) or None)
        self.steps: list[tuple[tuple, int, tuple]] = []

    @staticmethod
    def _grown(vector: tuple) -> Iterator[tuple[int, int, tuple, int]]:
        """Origins with 0 to 2 insertions (more only go round) and the state."""
        for origin, value in enumerate(vector):
            state = origin
            for n in range(3 if value else 0):
                yield origin, n, value, state
                state = _GROWN[state]

    def step(self, vector: tuple, initial: str, must_go: bool, cut: bool) -> int:
        key = (vector, initial, must_go, cut)
        if key in self.known:
            return self.known[key]
        best: list = [None] * 4
        for origin, n, (cost, rank), state in self._grown(vector):
            ways = [("D", state, DELETE)]
            if not must_go:
                stays = TRUNCATED if cut else 0
                if initial in _NEXT[state]:
                    ways.append(("K", _NEXT[state][initial], stays))
                ways.append(("R", _GROWN[state], REROLE + stays))
            for letter, to, price in ways:
                way = (cost + n * INSERT + price, rank, "I" * n + letter, origin, n)
                if best[to] is None or way < best[to]:
                    best[to] = way
        least = min(w[0] for w in best if w)
        order = sorted((w[1], w[2]) for w in best if w)
        made = tuple(w and (w[0] - least, order.index((w[1], w[2]))) for w in best)
        paths = tuple(w and (w[3], w[4], w[2][-1]) for w in best)
        self.known[key] = len(self.steps)
        self.steps.append((made, least, paths))
        return self.known[key]

    def end(self, vector: tuple) -> tuple[int, int, int]:
        """Cost above the least, origin and last insertions of the best end."""
        ends = [(cost + n * INSERT, rank, n, origin) for origin, n, (cost, rank), state in self._grown(vector) if state in _ENDS]
        cost, _, n, origin = min(ends)
        return cost, origin, n


class Backpointers:
    """Numbers of the solved steps of one conversation, read backwards."""

    def __init__(self, held: int):
        self.held, self.rows, self.file, self.parts = held, array("I"), None, 0

    def add(self, step: int) -> None:
        self.rows.append(step)
        if len(self.rows) == self.held:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.rows.tofile(self.file)
            self.parts, self.rows = self.parts + 1, array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.rows)
        for part in range(self.parts - 1, -1, -1):
            self.file.seek(part * self.held * self.rows.itemsize)
            rows = array("I")
            rows.fromfile(self.file, self.held)
            yield from reversed(rows)
        if self.file is not None:
            self.file.close()


def _said(running: tuple | None, role: str, text: str) -> tuple:
    """A running hash with one more message."""
    if running is None:
        made = hashlib.sha256(f"{role}:{text}".encode("utf-8", "surrogatepass"))
    else:
        made = running.copy()
        made.update(f"\n{role}:{text}".encode("utf-8", "surrogatepass"))
    return made


def _grow(running, state: int, n: int) -> tuple:
    for _ in range(n):
        state = _GROWN[state]
        running = _said(running, _ROLE[state], "")
    return running, state


_FULL = re.compile(r"[^\x20\x09-\x0D]")
_STOPS = frozenset(".!?")


class Conversation:
    """What the pass carries from row to row, and over batches."""

    def __init__(self, solver: Solver, held: int):
        self.solver, self.vector, self.cost = solver, Solver.START, 0
        self.back = Backpointers(held)
        self.hashes: list = [None] * 4
        self.low = self.high = self.last_turn = self.before = None
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        blank = not _FULL.search(text)
        again = again and not blank
        cut = not blank and not again and text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in _STOPS
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.last_turn:
                self.n_turns += 1
            self.high = self.last_turn = turn
        step = self.solver.step(self.vector, initial if initial in ("s", "u", "a") else "", blank or again, cut)
        self.vector, added, paths = self.solver.steps[step]
        self.cost += added
        self.back.add(step)
        hashes: list = [None] * 4
        for to, path in enumerate(paths):
            if path:
                running, state = _grow(self.hashes[path[0]], path[0], path[1])
                if path[2] == "K":
                    running = _said(running, role, text)
                elif path[2] == "R":
                    running = _said(running, _ROLE[_GROWN[state]], text)
                hashes[to] = running
        self.hashes = hashes

    def result(self) -> dict:
        more, state, n = self.solver.end(self.vector)
        running, _ = _grow(self.hashes[state], state, n)
        letters = ["I" * n]
        for step in self.back.backwards():
            origin, n, letter = self.solver.steps[step][2][state]
            letters.append(letter + "I" * n)
            state = origin
        return {
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.n_turns,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": self.cost + more,
            "audit": "".join(letters)[::-1],
            "repaired_sha256": (running or hashlib.sha256()).hexdigest(),
        }


def _ordered(messages: DataFrame) -> DataFrame:
    """Each conversation's rows in one partition, in order, with ``again``
    (role and text seen earlier).  One shuffle: the window's partitions lie
    within the conversations."""
    turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv_id", "role", "text").orderBy(turn)
    dealt = messages.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    return dealt.sortWithinPartitions("conv_id", turn, "role", "text")


def _plain(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``messages``; a null role or text is one space."""
    blank = F.lit(" ")
    return messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))


def repair(messages: DataFrame, held: int = _HELD) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, text):
    its faults and the cheapest edits.

    Rows are taken by turn, nulls first, then by role and text; rows that
    repeat are rows of their own (the later ones are duplicates).  A row's
    fault is the first that holds: ``blank`` (nothing but white space),
    ``duplicate`` (role and text seen earlier), ``truncated`` (the last
    character that isn't white space is none of ``.!?``).  ``gaps``: turns
    missing between the least and the largest; ``illegal``: neighbours whose
    role initials are not su, ua or au.  ``audit`` holds the initials of the
    edits (Keep, Rerole, Delete, Insert), the least string among the cheapest;
    ``repaired_sha256`` is of the repaired ``role:text`` lines.  A null role or
    text is one space; a null conv_id is a conversation of its own; other
    columns are not looked at; an empty table gives an empty result.

    A conversation is streamed by one task, whose memory is one Arrow batch,
    ``held`` backpointers and the audit string.
    """
    kind = messages.schema["conv_id"].dataType
    schema = messages.select("conv_id").withColumns({c: F.lit(None).cast(t) for c, t in RESULT.items()}).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solver, now, name, done = Solver(), None, None, []

        def close() -> None:
            if now is not None:
                done.append({"conv_id": name, **now.result()})

        for batch in batches:
            absent = batch["nothing"].tolist()
            ids = [None if x else i for i, x in zip(batch["conv_id"].tolist(), absent, strict=True)]
            turns = [None if x else int(t) for t, x in zip(batch["turn"].tolist(), batch["no_turn"].tolist(), strict=True)]
            for i, t, role, text, again in zip(ids, turns, batch["role"], batch["text"], batch["again"], strict=True):
                if now is None or i != name:
                    close()
                    now, name = Conversation(solver, held), i
                now.add(t, role, text, again)
            if len(done) >= 4096:
                yield pd.DataFrame(done, columns=schema.names)
                done = []
        close()
        if done:
            yield pd.DataFrame(done, columns=schema.names)

    # pandas has no null integers: nulls travel as flags
    zero = F.lit(0).cast("long")
    absent = F.lit("0").cast(kind)
    rows = _ordered(_plain(messages)).select(
        F.coalesce("conv_id", absent).alias("conv_id"),
        F.isnull("conv_id").alias("nothing"),
        F.coalesce("turn", zero).alias("turn"),
        F.isnull("turn").alias("no_turn"),
        "role",
        "text",
        "again",
    )
    return rows.mapInPandas(run, schema)


def repaired(messages: DataFrame) -> DataFrame:
    """The repaired conversations of ``messages``: conv_id, place (from 0),
    turn (null if inserted), role, text and edit (its initial).

    The edits of :func:`repair` are numbered and joined to the numbered rows.
    A rerole or an insertion takes the role that its place asks for.
    """
    edits = repair(messages).select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit <> ''")
    by_at = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edits = edits.withColumn("row", F.when(F.col("edit") != "I", F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(by_at)))
    edits = edits.where("edit <> 'D'").withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("at")) - 1)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = _plain(messages).withColumn("row", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    rows = rows.withColumnRenamed("conv_id", "of").withColumnRenamed("row", "nth")
    both = edits.join(rows, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("nth")), "left")
    system = F.max(F.when((F.col("place") == 0) & (F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(Window.partitionBy("conv_id"))
    asked = F.when((F.col("place") - system) % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return both.select(
        "conv_id", "place", "turn", F.when(F.col("edit") == "K", F.col("role")).otherwise(asked).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit"
    )


def damaged(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) with faults, by crc32 of
    ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it the user's.  A null counts as one
    space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = _plain(messages).withColumn("fault", F.crc32(key.cast("binary")) % 20).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def repair_damaged(messages: DataFrame) -> DataFrame:
    """:func:`repair` of the :func:`damaged` ``messages``, with a row for
    every conversation of ``messages``; one without rows has no faults, no
    edits and the hash of an empty text."""
    found = repair(damaged(messages))
    # a conversation's edits are one row, and so is its name
    none = {c: F.lit(0).cast("long") for c in RESULT} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    bare = messages.select("conv_id").distinct().withColumns(none).withColumn("found", F.lit(0))
    both = found.withColumn("found", F.lit(1)).unionByName(bare)
    return both.groupBy("conv_id").agg(*[F.max_by(c, "found").alias(c) for c in RESULT])

"""Conversation structure repair by secondary-sorted streaming.

Turns are dealt by conversation and sorted by turn; one pass over the sorted
Arrow batches carries, per conversation, a small state of a shortest-path
search: the cheapest cost of every grammar state, the order of their edit
strings, and a running digest of the text each would give. So the rows of a
conversation are never held together. What the search chose is kept as one
number per row (an index into a table of the few possible steps), which goes
to an anonymous file once a conversation is long, and is read backwards for
the audit string; texts seen earlier are kept as digests, which also go to an
anonymous database beyond a bound. Both live as long as the task: a lost
executor's tasks run again from the shuffle.

A conversation is repaired to role initials ``(s?(ua)+)?``. Edits: Keep 0,
Rerole to user or assistant 3, Delete 4 (the only one for blank and duplicate
rows), Insert an empty user or assistant turn 3; a truncated row that stays
adds 3. Of the cheapest edits those with the ASCII-least string of initials.

Null roles and texts count as one space; null turns come first; rows of equal
turn are taken in the order of role and text; a null conv_id is one
conversation; conversations without a row left, and an empty table, give
zeros and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sqlite3
import tempfile
from array import array
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Digests of texts and steps kept in memory per conversation.
SEEN_BOUND, STEPS_BOUND = 200_000, 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ROOM = " \t\n\v\f\r"
_LEGAL = {"su", "ua", "au"}

# Grammar states: nothing yet, after the system turn, after user, after
# assistant. NEXT gives the state a role initial leads to, ADDED the role that
# an inserted or reroled turn takes.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ADDED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
ACCEPTED = (START, ASSISTANT)
# More insertions in a row come back to a state already passed.
MAX_INSERTS = 2


def damage(rows: DataFrame) -> DataFrame:
    """Damaged ``conversations`` rows (conv_id, turn, role, text, dropped),
    by a checksum of conversation and turn; dropped rows stay marked, without
    text, so that their conversation is not lost."""
    t = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    t = t.withColumn("kind", kind).withColumn("n", F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == 3, 1).otherwise(0))))
    text = (F.when(F.col("kind") == 0, F.lit(None)).when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return t.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("kind") == 0).alias("dropped"))


def _inserted(state: int, n: int) -> int:
    for _ in range(n):
        state = NEXT[state, ADDED[state][0]]
    return state


@lru_cache(maxsize=None)
def _moves(initial: str, must_delete: bool, truncated: bool) -> list[tuple[int, int, int, int, str]]:
    """(from, to, cost, insertions, letter): every way to pass one row."""
    out = []
    for state in range(4):
        for n in range(MAX_INSERTS + 1):
            mid, paid = _inserted(state, n), INSERT * n
            out.append((state, mid, paid + DELETE, n, "D"))
            if not must_delete:
                extra = TRUNCATED if truncated else 0
                if (mid, initial) in NEXT:
                    out.append((state, NEXT[mid, initial], paid + extra, n, "K"))
                out.append((state, _inserted(mid, 1), paid + REROLE + extra, n, "R"))
    return out


class Steps:
    """The steps of the search, numbered as they come up.

    A vector holds, per grammar state, (cost above the cheapest, rank of its
    edit string) or None. Edit strings of different states that have passed
    the same rows end in a row's letter and differ before their ends, so their
    order is that of their ranks, then of what is added."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.table: list[tuple] = []

    def step(self, vector: tuple, row: tuple[str, bool, bool]) -> int:
        key = (vector, row)
        got = self.number.get(key)
        if got is None:
            got = self.number[key] = len(self.table)
            self.table.append(self._make(vector, row))
        return got

    @staticmethod
    def _make(vector: tuple, row: tuple) -> tuple:
        """(new vector, rise of the cheapest cost, {to: (from, insertions, letter)})."""
        best: dict[int, tuple] = {}
        for state, to, cost, n, letter in _moves(*row):
            if vector[state] is not None:
                above, rank = vector[state]
                new = (above + cost, rank, "I" * n + letter, state, n, letter)
                if to not in best or new < best[to]:
                    best[to] = new
        low = min(b[0] for b in best.values())
        order = sorted(best, key=lambda to: best[to][1:3])
        return (tuple((best[to][0] - low, order.index(to)) if to in best else None for to in range(4)), low,
                {to: b[3:] for to, b in best.items()})

    def finish(self, vector: tuple) -> tuple[int, int, int]:
        """(cost above the cheapest, state, insertions) of the best end."""
        ends = [(above + INSERT * n, rank, "I" * n, state, n)
                for state, v in enumerate(vector) if v is not None for above, rank in (v,)
                for n in range(MAX_INSERTS + 1) if _inserted(state, n) in ACCEPTED]
        cost, _, _, state, n = min(ends)
        return cost, state, n


class Seen:
    """Digests met so far, in a private on-disk database beyond a bound."""

    def __init__(self, bound: int = SEEN_BOUND):
        self.bound, self.near, self.far = bound, set(), None

    def add(self, digest: bytes) -> bool:
        """Whether the digest is new."""
        if digest in self.near or (self.far is not None and self.far.execute(
                "select 1 from seen where d = ?", (digest,)).fetchone()):
            return False
        self.near.add(digest)
        if len(self.near) >= self.bound:
            if self.far is None:
                self.far = sqlite3.connect("")
                self.far.execute("create table seen (d blob primary key) without rowid")
            self.far.executemany("insert into seen values (?)", ((d,) for d in sorted(self.near)))
            self.near = set()
        return True

    def close(self) -> None:
        if self.far is not None:
            self.far.close()


class Backpointers:
    """Step numbers of a conversation, in an anonymous file beyond a bound."""

    def __init__(self, bound: int = STEPS_BOUND):
        self.bound, self.near, self.file = bound, array("I"), None

    def append(self, number: int) -> None:
        self.near.append(number)
        if len(self.near) >= self.bound:
            self.file = self.file or tempfile.TemporaryFile()
            self.near.tofile(self.file)
            self.near = array("I")

    def backwards(self):
        yield from reversed(self.near)
        if self.file is not None:
            size, width = self.bound, self.near.itemsize
            for at in range(self.file.tell() // (size * width) - 1, -1, -1):
                self.file.seek(at * size * width)
                part = array("I")
                part.fromfile(self.file, size)
                yield from reversed(part)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Conversation:
    """The running state of one conversation."""

    def __init__(self, steps: Steps, seen_bound: int = SEEN_BOUND, steps_bound: int = STEPS_BOUND):
        self.steps, self.seen, self.chosen = steps, Seen(seen_bound), Backpointers(steps_bound)
        self.vector = ((0, 0), None, None, None)
        self.digest = [hashlib.sha256(), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low = self.high = self.turn = self.initial = None
        self.turns = 0

    def add(self, turn: str | None, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            self.turn, self.high, self.turns = turn, int(turn), self.turns + 1
            self.low = self.high if self.low is None else self.low
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial

        shown = text.rstrip(_ROOM)
        name = f"{len(role)}:{role}{text}".encode("utf-8", "replace")
        new = self.seen.add(hashlib.blake2b(name, digest_size=16).digest())
        blank, cut = not shown, bool(shown) and shown[-1] not in ".!?"
        if blank:
            self.blank += 1
        elif not new:
            self.duplicate += 1
        elif cut:
            self.truncated += 1
        must_delete = blank or not new
        number = self.steps.step(self.vector, (initial, must_delete, cut and not must_delete))
        self.chosen.append(number)
        self.vector, rise, how = self.steps.table[number]
        self.cost += rise

        digest: list = [None] * 4
        for to, (state, n, letter) in how.items():
            if n == 0 and letter == "D":
                digest[to] = self.digest[state]  # digests are only changed as copies
                continue
            got, mid = self.digest[state].copy(), state
            for _ in range(n):
                mid = self._put(got, mid, ADDED[mid], "")
            if letter != "D":
                self._put(got, mid, role if letter == "K" else ADDED[mid], text)
            digest[to] = got
        self.digest = digest

    @staticmethod
    def _put(digest, state: int, role: str, text: str) -> int:
        line = f"{role}:{text}" if state == START else f"\n{role}:{text}"
        digest.update(line.encode("utf-8", "replace"))
        return NEXT[state, role[0]]

    def result(self) -> dict:
        above, state, n = self.steps.finish(self.vector)
        digest, mid = self.digest[state].copy(), state
        for _ in range(n):
            mid = self._put(digest, mid, ADDED[mid], "")
        audit = bytearray(b"I" * n)
        for number in self.chosen.backwards():
            state, k, letter = self.steps.table[number][2][state]
            audit += letter.encode() + b"I" * k
        audit.reverse()
        self.seen.close()
        self.chosen.close()
        return {"gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": self.cost + above, "audit": audit.decode(), "repaired_sha256": digest.hexdigest()}


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) per conversation of (conv_id, turn, role, text, dropped);
    ``dropped`` rows only name their conversation."""
    kind = rows.schema["conv_id"].dataType
    dealt = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    sent = dealt.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").cast("string").alias("turn"),
                        "role", "text", "dropped")

    def run(batches):
        steps, key, talk, done = Steps(), None, None, []

        def frame():
            return pd.DataFrame([k | r for k, r in done], columns=["key", *FIELDS, "audit", "repaired_sha256"])

        for b in batches:
            for k, turn, role, text, dropped in zip(b["key"], b["turn"], b["role"], b["text"], b["dropped"]):
                if talk is None or k != key:
                    if talk is not None:
                        done.append(({"key": key}, talk.result()))
                    key, talk = k, Conversation(steps)
                if not dropped:
                    talk.add(turn, role, text)
            if done:
                yield frame()
                done.clear()
        if talk is not None:
            done.append(({"key": key}, talk.result()))
            yield frame()

    schema = "key string, " + ", ".join(f"{c} long" for c in FIELDS) + ", audit string, repaired_sha256 string"
    return sent.mapInPandas(run, schema).select(
        F.col("key").cast(kind).alias("conv_id"), *FIELDS, "audit", "repaired_sha256")


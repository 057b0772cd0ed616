"""Repair of conversations whose turns were lost, emptied, cut, repeated or given to the wrong speaker.

Method: iterative-deepening A*. Edits are tried depth first in the order of their letters (Delete, Insert, Keep, Rerole)
under a bound on the cost, which rises to the least cost that the last search found necessary; a table keeps, for each
place and state where a search failed, what is at least needed from there. The first path that is accepted is
therefore the cheapest, and of the cheapest the least by letters.

A conversation of any length is cut into segments of bounded length by a range partitioning on its turns. A
conversation that lies in one segment is searched as a whole. Of longer ones each segment is searched for every state in
which it may begin and end; inserts belong to the row that follows, so no audit of a segment is the beginning of another
one over the same rows, and the best whole is made of best segments. They are put together in a stream that keeps four
states, each with its cost and running digest. A digest is sequential by nature, so that last step, which only
compares and hashes, is one task a conversation; searching, counting and sorting are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identity, materialize

#: Faults of a row, the first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

#: States: nothing kept yet, after system, after user, after assistant; END stands for the end of the conversation.
_START, _SYSTEM, _USER, _ASSISTANT, END = range(5)
#: State that a role's initial leads to, and the speaker that a rerole or insert gives in each state.
_FOLLOWS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_SPEAKER = {_START: "user", _SYSTEM: "user", _USER: "assistant", _ASSISTANT: "user"}
#: Inserts that a conversation still needs where it ends in this state.
_TAILS = {_START: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
_LEGAL = {"su", "ua", "au"}
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
_NEVER = 1 << 60

#: Distinct rows of a segment at most.
SEGMENT = 64


@dataclass(slots=True)
class Row:
    """A row that occurs ``copies`` times in succession; the further copies are duplicates, or blank like it."""

    role: str
    text: str
    fault: int
    copies: int = 1


class Search:
    """The cheapest edits of some rows from a state to ``goal``; what failed searches learn is kept for the next state."""

    def __init__(self, rows: list[Row], goal: int):
        self.rows, self.goal = rows, goal
        self.extra = [DELETE * (r.copies - 1) for r in rows]
        rest, table = 0, []
        for r, extra in zip(reversed(rows), reversed(self.extra), strict=True):
            rest += extra + (DELETE if r.fault in (BLANK, DUPLICATE) else CUT if r.fault == TRUNCATED else 0)
            table.append([rest] * 4)
        last = [INSERT * len(_TAILS[s]) if goal == END else 0 if s == goal else _NEVER for s in range(4)]
        self.needed = [*reversed(table), last]  # never more than the cost from there

    def edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(letter, cost, next place, next state) in the order of letters; a row's further copies go with it."""
        other = _FOLLOWS[state, _SPEAKER[state][0]]
        if i == len(self.rows):
            if self.goal == END:
                yield "I", INSERT, i, other
            return
        row, extra = self.rows[i], self.extra[i]
        more = "D" * (row.copies - 1)
        yield "D" + more, DELETE + extra, i + 1, state
        yield "I", INSERT, i, other
        if row.fault in (SOUND, TRUNCATED):
            cut = extra + (CUT if row.fault == TRUNCATED else 0)
            if (kept := _FOLLOWS.get((state, row.role[:1]))) is not None:
                yield "K" + more, cut, i + 1, kept
            yield "R" + more, REROLE + cut, i + 1, other

    def done(self, i: int, state: int) -> bool:
        return i == len(self.rows) and (state in (_START, _ASSISTANT) if self.goal == END else state == self.goal)

    def within(self, state: int, bound: int) -> list[str] | None:
        """The first accepted path of at most this cost, depth first without recursion."""
        if self.needed[0][state] > bound:
            return None
        path, stack = [], [(0, state, bound, self.edits(0, state), [_NEVER])]
        if self.done(0, state):
            return path
        while stack:
            i, s, left, edits, least = stack[-1]
            for letter, cost, j, t in edits:
                if cost + self.needed[j][t] <= left:
                    path.append(letter)
                    if self.done(j, t):
                        return path
                    stack.append((j, t, left - cost, self.edits(j, t), [_NEVER]))
                    break
                least[0] = min(least[0], cost + self.needed[j][t])
            else:
                self.needed[i][s] = max(self.needed[i][s], least[0])
                stack.pop()
                if stack:
                    path.pop()
                    up = stack[-1]
                    # the edit that failed costs what is left above minus what was left here, and what is now known to be needed
                    up[4][0] = min(up[4][0], up[2] - left + self.needed[i][s])
        return None

    def reachable(self, state: int) -> bool:
        """Whether any edits lead to the goal: without rows kept or reroled only deletes keep the start, and no edit makes a system row."""
        if self.goal == _START:
            return state == _START
        if self.goal == _SYSTEM:
            return state == _SYSTEM or state == _START and any(r.role[:1] == "s" and r.fault in (SOUND, TRUNCATED) for r in self.rows)
        return True

    def best(self, state: int) -> tuple[int, str] | None:
        """(cost, audit), or None where the goal can't be reached."""
        if not self.reachable(state):
            return None
        while (path := self.within(state, self.needed[0][state])) is None:
            pass  # a failed search has raised what is needed
        return self.needed[0][state], "".join(path)


def repaired(rows: list[Row], entry: int, audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of what the edits leave."""
    state, each = entry, (r for r in rows for _ in range(r.copies))
    for letter in audit:
        if letter == "I":
            role, text = _SPEAKER[state], ""
        else:
            row = next(each)
            if letter == "D":
                continue
            role, text = (row.role if letter == "K" else _SPEAKER[state]), row.text
        yield role, text
        state = _FOLLOWS[state, role[0]]


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the crc32 of ``conv_id:turn``, modulo 20, names; nulls are one space there."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(text_col), blank)
    broken = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), kind.alias("kind"), F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role_col), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return broken.where("kind <> 0").select("conv_id", "turn", "role", "text", twice.alias("copy")).drop("copy")


def _faulty(df: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, ``sha`` and the first copy's ``fault``. Copies are merged before the shuffle."""
    rows = df.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("sha", F.sha2("text", 256))
    rows = materialize(rows, "turns")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    spoken = rows.groupBy("conv_id", "role", "sha").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
    again = materialize(spoken.select(identity("conv_id").alias("key"), "role", "sha", "first"), "again")  # so the join can split a hot key
    joined = rows.withColumn("key", identity("conv_id")).join(again, ["key", "role", "sha"], "left").drop("key")
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    later = F.coalesce(at > F.col("first"), F.lit(False))
    fault = F.when(F.length(bare) == 0, BLANK).when(later, DUPLICATE).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    return joined.select("conv_id", "turn", "role", "text", "copies", "sha", fault.alias("fault"))


def _plans(rows: list[Row], opens: bool, closes: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of each state that the segment may begin and end in."""
    out = []
    for goal in (END,) if closes else range(4):
        search = Search(rows, goal)
        for entry in (_START,) if opens else range(4):
            if (found := search.best(entry)) is not None:
                out.append((entry, goal, *found))
    return out


def _segments(df: DataFrame, size: int) -> DataFrame:
    """A row for each run of at most ``size`` distinct rows of a conversation, with its best edits and counts."""
    kind = {c: df.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = (
        f"conv_id {kind['conv_id']}, seq long, opens boolean, closes boolean, rows array<struct<role: string, text: string, fault: int, copies: long>>, plans array<struct<entry: int, goal: int, cost: long, audit: string>>, "
        "low long, high long, turns long, blank long, duplicate long, truncated long, first string, last string, illegal long"
    )

    def run(batches):
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 33

        def record(conv, rows, turns, opens, closes) -> dict:
            nonlocal seq
            seq += 1
            initials = [r.role[:1] for r in rows]
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)) + sum(r.copies - 1 for r in rows)
            own = [t for t in turns if t is not None]
            return {
                "conv_id": conv, "seq": seq, "opens": opens, "closes": closes, "rows": [{"role": r.role, "text": r.text, "fault": r.fault, "copies": r.copies} for r in rows],
                "plans": [dict(zip(("entry", "goal", "cost", "audit"), p, strict=True)) for p in _plans(rows, opens, closes)],
                "low": min(own, default=None), "high": max(own, default=None), "turns": len(set(own)), "blank": sum(r.copies for r in rows if r.fault == BLANK),
                "duplicate": sum(r.copies - (r.fault != DUPLICATE) for r in rows if r.fault != BLANK), "truncated": sum(r.fault == TRUNCATED for r in rows),
                "first": initials[0], "last": initials[-1], "illegal": illegal,
            }

        types = None
        conv, rows, turns, opens, seen = None, [], [], False, False
        ready: list[dict] = []
        for b in batches:
            types = types or pa.schema([b.schema.field("conv_id"), *_SEGMENT_FIELDS])
            for r in b.to_pylist():
                fresh = not seen or r["conv_id"] != conv
                if rows and (fresh or len(rows) == size):
                    ready.append(record(conv, rows, turns, opens, fresh))
                    rows, turns, opens = [], [], False
                if fresh:
                    opens = seen  # the first of a partition may go on from the one before
                conv, seen = r["conv_id"], True
                rows.append(Row(r["role"], r["text"], r["fault"], r["copies"]))
                turns.append(r["turn"])
            if ready:
                yield pa.RecordBatch.from_pylist(ready, types)
                ready = []
        if rows:
            yield pa.RecordBatch.from_pylist([record(conv, rows, turns, opens, False)], types)

    order = ["conv_id", "turn", "role", "sha"]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "role", "text", "fault", "copies").mapInArrow(run, schema)


_SEGMENT_FIELDS = [
    pa.field("seq", pa.int64()), pa.field("opens", pa.bool_()), pa.field("closes", pa.bool_()),
    pa.field("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.int32()), ("copies", pa.int64())]))),
    pa.field("plans", pa.list_(pa.struct([("entry", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    *(pa.field(n, pa.int64()) for n in ("low", "high", "turns", "blank", "duplicate", "truncated")), pa.field("first", pa.string()), pa.field("last", pa.string()), pa.field("illegal", pa.int64()),
]


class _Whole:
    """The segments of one conversation so far: for each state the best way into it."""

    def __init__(self):
        # state: (cost, rank among states by audit, digest, whether it has lines, (way before, seq, entry, audit))
        self.ways = {_START: (0, 0, hashlib.sha256(), False, None)}
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.low = self.high = self.last = None
        self.ended = False

    def add(self, s: dict) -> None:
        rows = [Row(**r) for r in s["rows"]]
        found: dict[int, tuple] = {}
        for p in s["plans"]:
            if (way := self.ways.get(p["entry"])) is not None:
                offer = (way[0] + p["cost"], way[1], p["audit"], p["entry"])
                found[p["goal"]] = min(found.get(p["goal"], offer), offer)
        ranks = {goal: i for i, goal in enumerate(sorted(found, key=lambda g: found[g][1:3]))}
        self.ways = {g: self._extended(rows, s["seq"], ranks[g], *found[g]) for g in found}
        self.ended = s["closes"]
        for k in self.sums:
            self.sums[k] += s[k]
        if self.last is not None:
            self.sums["illegal"] += self.last + s["first"] not in _LEGAL
        self.last = s["last"]
        if s["low"] is not None:
            self.sums["turns"] -= self.high == s["low"]  # a turn that goes on in this segment
            self.low, self.high = s["low"] if self.low is None else self.low, s["high"]

    def _extended(self, rows, seq, rank, cost, _, audit, entry) -> tuple:
        _, _, digest, lines, before = self.ways[entry]
        digest = digest.copy()
        for role, text in repaired(rows, entry, audit):
            digest.update(f"{'\n' if lines else ''}{role}:{text}".encode())
            lines = True
        return cost, rank, digest, lines, (before, seq, entry, audit)

    def close(self) -> tuple:
        """The best way as a whole; a conversation that ends with its partition still lacks the last inserts."""
        if self.ended:
            return self.ways[END]
        cost, _, tail, state = min((w[0] + INSERT * len(_TAILS[s]), w[1], _TAILS[s], s) for s, w in self.ways.items())
        return self._extended([], None, 0, cost, 0, tail, state)


def _wholes(batches) -> Iterator[tuple[object, _Whole]]:
    """Conversations of segments that come sorted."""
    conv, whole = None, None
    for b in batches:
        for s in b.to_pylist():
            if whole is None or s["conv_id"] != conv:
                if whole is not None:
                    yield conv, whole
                conv, whole = s["conv_id"], _Whole()
            whole.add(s)
    if whole is not None:
        yield conv, whole


def _path(whole: _Whole) -> list[tuple[int | None, int, str]]:
    step, out = whole.close()[4], []
    while step is not None:
        step, *own = step
        out.append(tuple(own))
    return out[::-1]


def _ordered(df: DataFrame, segment: int) -> DataFrame:
    return _segments(_faulty(df), segment)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_conversations(df: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``df`` has conv_id, turn, role and text; other columns are ignored, null roles and texts count as empty. Rows are
    taken by turn (nulls first), those of one turn by role and SHA-256 of the text; equal ones are neighbours, of which
    the first may stay. Null ids are one conversation. ``audit`` has a letter for each edit: Delete (4), Insert (3),
    Keep (0), Rerole (3); a truncated row that stays costs 3 more. ``repaired_sha256`` is that of ``repaired_turns``
    as ``role:text``, joined by newlines. ``segment`` changes no result. An empty table gives no rows.
    """
    spoken = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = df.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"

    def run(batches):
        types = None

        def batch(rows):
            return pa.RecordBatch.from_pylist(rows, pa.schema([types, *(pa.field(c, pa.int64()) for c in _COUNTS), pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())]))

        def noted(source):
            nonlocal types
            for b in source:
                types = types or b.schema.field("conv_id")
                yield b

        ready = []
        for conv, w in _wholes(noted(batches)):
            gaps = 0 if w.low is None else w.high - w.low + 1 - w.sums["turns"]
            cost, _, digest, _, _ = w.close()
            ready.append({"conv_id": conv, "gaps": gaps, **{c: w.sums[c] for c in _COUNTS[1:5]}, "cost": cost, "audit": "".join(p[2] for p in _path(w)), "repaired_sha256": digest.hexdigest()})
            if len(ready) == 1000:
                yield batch(ready)
                ready = []
        if ready:
            yield batch(ready)

    dealt = _ordered(spoken, segment).repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return dealt.mapInArrow(run, schema)


def repaired_turns(df: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, seq, place, role, text): the repaired conversations, in the order of (seq, place). See ``repair_conversations``."""
    spoken = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    segments = materialize(_ordered(spoken, segment), "segments")
    kind = df.schema["conv_id"].dataType.simpleString()
    last = 1 << 62

    def paths(batches):
        types = None

        def noted(source):
            nonlocal types
            for b in source:
                types = types or b.schema.field("conv_id")
                yield b

        for conv, w in _wholes(noted(batches)):
            rows = [{"conv_id": conv, "seq": last if seq is None else seq, "entry": entry, "audit": audit} for seq, entry, audit in _path(w)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([types, pa.field("seq", pa.int64()), pa.field("entry", pa.int32()), pa.field("audit", pa.string())]))

    def lines(batches):
        for b in batches:
            rows = [
                {"conv_id": r["conv_id"], "seq": r["seq"], "place": i, "role": role, "text": text}
                for r in b.to_pylist()
                for i, (role, text) in enumerate(repaired([Row(**x) for x in r["rows"] or ()], r["entry"], r["audit"]))
            ]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([b.schema.field("conv_id"), *(pa.field(c, t) for c, t in (("seq", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())))]))

    chosen = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(paths, f"conv_id {kind}, seq long, entry int, audit string")
    keyed = chosen.withColumn("key", identity("conv_id")).join(segments.select(identity("conv_id").alias("key"), "seq", "rows"), ["key", "seq"], "left")
    return keyed.select("conv_id", "seq", "entry", "audit", "rows").mapInArrow(lines, f"conv_id {kind}, seq long, place long, role string, text string")


def repair_report(df: DataFrame, damaged: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``repair_conversations(damaged)`` for every conv_id of ``df``; one that lost all rows has zeros and empty edits."""
    found = repair_conversations(damaged, segment).withColumn("key", identity("conv_id")).drop("conv_id")
    every = df.select("conv_id").distinct().withColumn("key", identity("conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    joined = every.join(found, "key", "left")
    return joined.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

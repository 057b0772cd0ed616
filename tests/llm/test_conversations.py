"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from segloom.llm import conversations as c
from segloom.llm import queries as q

WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repair(rows):
    """Uniform-cost search in the order (cost, letters): the first accepted path is the answer."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    counts = [max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))]
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    speaker = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return (*counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), [tuple(x.split(":", 1)) for x in lines]
        if (i, state) in done:
            continue
        done.add((i, state))
        say = speaker[state]
        heapq.heappush(heap, (cost + 3, audit + "I", i, follows[state, say[0]], (*lines, f"{say}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                cut = 3 * (faults[i] == "truncated")
                if (state, role[:1]) in follows:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, follows[state, role[:1]], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + cut, audit + "R", i + 1, follows[state, say[0]], (*lines, f"{say}:{text}")))
    raise AssertionError


def talk(rng, conv, n):
    texts = ["Hello.", "Why?", "cut off", "", " \t", "Done!", "a:b\nc. ", None, "Ends with space? \x0b"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    return [(conv, rng.choice([i, i, i, i + 1, 0, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Sentence {rng.randrange(99)}.") for i in range(n)]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    rows = [r for conv in range(150) for r in talk(rng, conv, rng.randrange(1, 14))]
    rows += talk(rng, None, 6) + talk(rng, 1000, 300) + [(1001, 1, "user", "The same. ")] * 40 + [(1002, None, "system", "Only one.")]
    rows += [(1003, i, "user", "The same.") for i in range(90)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)


def by_conversation(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


@pytest.mark.parametrize("segment", [64, 3, 1])
def test_repair_equals_search(spark, talks, segment):
    df = frame(spark, talks)
    got = {r["conv_id"]: tuple(r)[1:] for r in c.repair_report(df, c.damage(df), segment).collect()}
    left = by_conversation(damaged(talks))
    want = {conv: repair(left[conv])[0] for conv in by_conversation(talks)}
    assert got == want
    assert any("R" in v[6] for v in want.values()) and any("I" in v[6] for v in want.values())


def test_undamaged_rows_and_turns(spark, talks):
    rows = [(a, b, r or "", t or "") for a, b, r, t in talks]
    df = frame(spark, talks)
    want = {conv: repair(own) for conv, own in by_conversation(rows).items()}
    assert {r["conv_id"]: tuple(r)[1:] for r in c.repair_conversations(df).collect()} == {k: v[0] for k, v in want.items()}
    lines = defaultdict(list)
    for r in sorted(c.repaired_turns(df, 5).collect(), key=lambda r: (r["seq"], r["place"])):
        lines[r["conv_id"]].append((r["role"], r["text"]))
    assert lines == {k: v[1] for k, v in want.items() if v[1]}


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(damaged(rows))
    got = {r["conv_id"]: tuple(r)[1:] for r in q.QUERIES["op13_conversation_repair"](spark, sf).collect()}
    assert got == {conv: repair(left[conv])[0] for conv in by_conversation(rows)}


def test_plain_cases():
    row = c.Row
    assert c.Search([], c.END).best(0) == (0, "")
    assert c.Search([row("user", "Hi.", c.SOUND)], c.END).best(0) == (3, "KI")
    assert c.Search([row("system", "Hi.", c.SOUND)], c.END).best(0) == (4, "D")
    assert c.Search([row("assistant", "Hi.", c.SOUND)], c.END).best(0) == (3, "IK")
    assert c.Search([row("user", "Hi.", c.SOUND, 3)], c.END).best(0) == (11, "KDDI")
    assert c.Search([row("user", "Hi", c.TRUNCATED)], c.END).best(0) == (4, "D")


def test_odd_rows(spark):
    none = frame(spark, [], 1)
    assert c.repair_report(none, c.damage(none)).collect() == []
    assert c.repaired_turns(none).collect() == []
    names = ["key", "seq", "rows", "sha", "copies", "fault", "first", "n", "kind", "copy", "cost", "audit"]
    df = frame(spark, [(1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (None, 2, "user", "Hi.")]).selectExpr("*", *(f"'x' as {n}" for n in names))
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in c.repair_conversations(df).collect()} == {1: (7, "KDI"), None: (3, "KI")}
    lost = frame(spark, [(0, t, "user", "Hi.") for t in range(2000) if zlib.crc32(f"0:{t}".encode()) % 20 == 0])
    assert [tuple(r) for r in c.repair_report(lost, c.damage(lost)).collect()] == [(0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]

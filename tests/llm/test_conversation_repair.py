"""Repair against plain recursion over all edits, and by damaged conversations as a whole."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from augury.llm import conversation_repair as module
from augury.llm import queries
from augury.llm.conversation_repair import repair_conversations

from .conftest import SMALL

SPACE = r"\x20\x09-\x0D"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        if not re.search(f"[^{SPACE}]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if re.search(rf"[.!?][{SPACE}]*\Z", text) else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit, lines) over all edit lists; what was said is the last initial."""

    @lru_cache(None)
    def way(i, said, inserted):
        ways = [(0, "", ())] if i == len(rows) and said in ("", "a") else []

        def take(cost, letter, line, then):
            ways.append((cost + then[0], letter + then[1], line + then[2]))

        def follows(initial):
            return {"": initial in "su", "s": initial == "u", "u": initial == "a", "a": initial == "u"}[said]

        if inserted < 2:  # three insertions in a row are never cheapest
            for role in ("user", "assistant"):
                if follows(role[0]):
                    take(5, "I", ((role, ""),), way(i, role[0], inserted + 1))
        if i < len(rows):
            role, text = rows[i]
            take(2, "D", (), way(i + 1, said, 0))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                if role[:1] in ("s", "u", "a") and follows(role[0]):
                    take(extra, "K", ((role, text),), way(i + 1, role[0], 0))
                for new in ("user", "assistant"):
                    if follows(new[0]):
                        take(1 + extra, "R", ((new, text),), way(i + 1, new[0], 0))
        return min(ways, default=(10**9, "", ()))

    return way(0, "", 0)


def expected(conv_id, rows):
    """``rows``: (turn, role, text), in order."""
    faults = faults_of([r[1:] for r in rows])
    cost, audit, lines = cheapest(tuple(r[1:] for r in rows), faults)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        out.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, x in out.items()}


@pytest.mark.parametrize("bits", [12, 3, 1])
def test_equals_plain_recursion(spark, bits):
    """Chunks of 4096, 8 and 2 rows: conversations lie in one chunk, or in very many."""
    r = random.Random(4)
    rows = []
    for conv in range(1, 120):
        for _ in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Yes.", "No!", "Why?", "cut off", "", " \n", None, "a. \t", "Ends.\x1c", "é…"])
            rows.append((None if conv % 17 == 0 else conv, r.choice([None, *range(9), 40]), role, text))
    rows += rows[:30]
    clash = "gaps string, pos int, kind string, chunk string, said int"
    df = spark.createDataFrame([(*x, "g", 1, "k", "c", 2) for x in rows], f"conv_id long, turn long, role string, text string, {clash}")
    out = repair_conversations(df.repartition(3), chunk_bits=bits)
    assert sorted(map(tuple, out.collect()), key=str) == sorted((expected(c, x) for c, x in in_order(rows).items()), key=str)


def test_one_very_long_conversation_among_others(spark):
    r = random.Random(6)
    rows = [(5, i, r.choice(["user", "assistant"]), f"Line {r.randint(0, 12_000)}{r.choice('.,!')}") for i in range(12_000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", "Fine.") for c in (1, 9) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["conv_id"]: x for x in repair_conversations(df, with_text=True).collect()}
    faults = module.np.array([{"": 0, "blank": 1, "duplicate": 2, "truncated": 3}[f] for f in faults_of([x[2:] for x in rows[:12_000]])])
    kinds = [2 if x[2] == "user" else 3 for x in rows[:12_000]]
    assert got[5]["cost"] == module.costs_to_go(kinds, faults.tolist(), module.ENDED)[0][0]
    roles = [line.split(":")[0] for line in got[5]["repaired"].split("\n")]
    assert roles == ["user", "assistant"] * (len(roles) // 2)
    assert hashlib.sha256(got[5]["repaired"].encode()).hexdigest() == got[5]["repaired_sha256"]
    prices = {"K": 0, "R": 1, "D": 2, "I": 5}
    at, total = -1, 0
    for letter in got[5]["audit"]:
        at += letter != "I"
        total += prices[letter] + 5 * (letter in "KR" and faults[at] == 3)
    assert total == got[5]["cost"] and at == 11_999
    assert got[1]["audit"] == got[9]["audit"] == "KK"


def test_empty_and_known(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = spark.createDataFrame([], schema)
    assert repair_conversations(none).count() == 0
    known = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert sorted(map(tuple, repair_conversations(none, known=known).collect()), key=str) == [(1, *nothing), (None, *nothing)]


def test_query_equals_plain_recursion(spark):
    rows = []
    original = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    for x in original:
        fault = zlib.crc32(f"{x['conv_id']}:{x['turn']}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", x["text"]) if fault == 2 else x["text"]
        rows += [(x["conv_id"], x["turn"], "user" if fault == 4 else x["role"], text)] * {0: 0, 3: 2}.get(fault, 1)
    want = {c: (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {x["conv_id"] for x in original}}
    want |= {c: expected(c, x) for c, x in in_order(rows).items()}
    out = queries.op13_path_ranked_repair(spark, SMALL)
    assert sorted(map(tuple, out.collect())) == sorted(want.values())
    assert dict(out.dtypes) == {c: "string" if c in ("audit", "repaired_sha256") else "bigint" for c in out.columns}


def test_missing_values_are_one_space_when_faults_are_planted(spark):
    rows = [(i, None, None, None) for i in range(40)] + [(None, t, "user", None) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    keys = [zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, _, _ in rows]
    out = queries.with_planted_faults(df).collect()
    assert len(out) == sum({0: 0, 3: 2}.get(k, 1) for k in keys)
    assert {x["text"] for x in out} == {" ", ""} and {x["role"] for x in out} == {" ", "user"}

"""Conversation repair against a plain dynamic program over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest

from itemwise.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, pos long, conv string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def best(rows):
    """Least (cost, audit) with the repaired turns, over all rows at once."""
    def better(at, key, label):
        if key not in at or label[:2] < at[key][:2]:
            at[key] = label

    def inserted(now):
        for _ in range(3):
            for s, (c, a, out) in list(now.items()):
                role = {"u": "user", "a": "assistant"}[FOLLOWS[s]]
                better(now, FOLLOWS[s], (c + 5, a + "I", [*out, f"{role}:"]))
        return now

    now = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        then = {}
        for s, (c, a, out) in now.items():
            better(then, s, (c + 2, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            to = FOLLOWS[s]
            if role[:1] == to or (s == "" and role[:1] == "s"):
                better(then, role[:1], (c + extra, a + "K", [*out, f"{role}:{text}"]))
            new = {"u": "user", "a": "assistant"}[to]
            better(then, to, (c + 1 + extra, a + "R", [*out, f"{new}:{text}"]))
        now = inserted(then)
    cost, audit, out = min(now[s] for s in ("", "a") if s in now)
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows):
    out, after = [], damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            found = WORD.findall(text)
            fault = ("blank" if not found else "duplicate" if (role, text) in seen
                     else "truncated" if found[-1] not in ".!?" else None)
            seen.add((role, text))
            faults.append(fault)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, sha = best([(r[2], r[3], f) for r, f in zip(own, faults, strict=True)])
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    illegal, cost, audit, sha))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = repair.damaged_and_repaired(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                           "audit", "repaired_sha256"]
    key = lambda r: str(r[0])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


def chat(rng, conv, n):
    texts = ["Hi.", "Why?", "so it goes", " \t", "", None, "Good! ", "end.\x0b", "héé?", "x" * 3000]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "User", "", None, "unknown"]
    return [(conv, rng.choice([i, i, i, i // 2, None]) if rng.random() < .3 else i,
             ("system" if i == 0 and rng.random() < .4 else
              rng.choice(roles) if rng.random() < .3 else ("user", "assistant")[i % 2]),
             rng.choice(texts) if rng.random() < .4 else f"turn {i}.") for i in range(n)]


def test_many_short_conversations(spark):
    rng = random.Random(5)
    rows = sum((chat(rng, c, rng.randint(1, 9)) for c in range(160)), [])
    rows += chat(rng, None, 12) + rows[:7] + [(900, None, None, None), (901, 3, "user", "ok.")]
    check(spark, rows)


def test_one_long_conversation_in_blocks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 4)
    monkeypatch.setattr(repair, "FAN", 3)
    rng = random.Random(8)
    rows = chat(rng, 1, 260) + chat(rng, 2, 30) + chat(rng, 3, 4) + chat(rng, 4, 5)
    rows += [(5, i, "user", "Again.") for i in range(90)]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, n):
    # the drop of (conv, turn) leaves a conversation without rows
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check(spark, [(gone, 0, "user", "Hi.")][:n])


def test_both_searches_agree_on_every_state():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(rng.choice("suaux "), rng.random() < .2, rng.random() < .2)
                for _ in range(rng.randint(1, 24))]
        width = rng.randint(1, 6)
        parts = [repair._summary(rows[i: i + width], repair.STATES)
                 for i in range(0, len(rows), width)]
        cost, order, audits = repair._summary(rows, repair.STATES)
        children = [p[:2] for p in parts]
        assert repair.combine(children)[0] == cost
        for s in repair.STATES:
            for t in repair.STATES:
                if cost[4 * s + t] < repair.NONE:
                    states = repair.path(children, s, t)
                    assert audits[4 * s + t] == "".join(
                        p[2][4 * a + b] for p, a, b in zip(parts, states, states[1:]))

"""Conversation repair against exhaustive search over audits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from keelson.llm import queries, turn_repair
from tests.conftest import MEDIUM, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        words = WORD.findall(text)
        out.append(0 if words else 1)
        if words:
            out[-1] = 2 if (role, text) in seen else 3 if words[-1] not in ".!?" else 0
        seen.add((role, text))
    return out


def apply(audit, rows, faults):
    """The repaired rows and the cost of an audit; None if it doesn't fit the rows or the grammar."""
    out, cost, at = [], 0, 0
    for edit in audit:
        want = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((want, ""))
            cost += 2
            continue
        if at == len(rows):
            return None
        (role, text), fault = rows[at], faults[at]
        at += 1
        if edit == "D":
            cost += 3
            continue
        if fault in (1, 2):
            return None
        out.append((want if edit == "R" else role, text))
        cost += (2 if edit == "R" else 0) + (fault == 3)
    if at < len(rows) or not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
        return None
    return cost, out


def exhaustive(rows, faults):
    best = None
    for n in range(len(rows), len(rows) + 5):
        for audit in itertools.product("DIKR", repeat=n):
            if audit.count("I") == n - len(rows):
                found = apply(audit, rows, faults)
                if found and (best is None or (found[0], "".join(audit)) < best[:2]):
                    best = (found[0], "".join(audit), found[1])
    return best


def searched(rows, faults):
    """The same by dynamic programming over whole audits, from the front of the rest, for longer conversations."""
    memo = {}

    def best(i, q, spare):
        key = (i, q, spare)
        if key not in memo:
            want = "a" if q == "u" else "u"
            options = [(0, "")] if i == len(rows) and q in ("", "a") else []
            if spare:
                c, a = best(i, want, spare - 1)
                options.append((c + 2, "I" + a))
            if i < len(rows):
                kind, fault = rows[i][0][:1] or "-", faults[i]
                c, a = best(i + 1, q, 3)
                options.append((c + 3, "D" + a))
                if fault in (0, 3):
                    c, a = best(i + 1, want, 3)
                    options.append((c + 2 + (fault == 3), "R" + a))
                    if kind == want or (kind == "s" and q == ""):
                        c, a = best(i + 1, kind, 3)
                        options.append((c + (fault == 3), "K" + a))
            memo[key] = min(options, default=(10**9, ""))
        return memo[key]

    cost, audit = best(0, "", 3)
    return cost, audit, apply(audit, rows, faults)[1]


def summary(ordered, solve=searched):
    turns, rows = [t[0] for t in ordered], [t[1:] for t in ordered]
    faults = faults_of(rows)
    cost, audit, out = solve(rows, faults)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha)


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_search_equals_exhaustive_search():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "a."])) for _ in range(rng.randint(0, 4))]
        faults = faults_of(rows)
        assert searched(rows, faults) == exhaustive(rows, faults)


def test_automaton_equals_search():
    rng = random.Random(2)
    signatures = {"".join(rng.choice("suaxdSUAX") for _ in range(rng.randint(0, 12))) for _ in range(2000)}
    dawg, roles = turn_repair.Dawg(), {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    for s in sorted(signatures, key=lambda s: s[::-1]):
        rows = [(roles[c.lower()], "") for c in s]
        faults = [1 if c == "d" else 3 if c.isupper() else 0 for c in s]
        assert dawg.solve(s) == searched(rows, faults)[:2]


def damage(rows):
    """(conv_id, [(turn, role, text)]) after the contract's damage."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def in_turn_order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0))


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_given_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: summary(in_turn_order(ts)) for c, ts in damage(rows).items()}
    got = queries.op13_turn_repair(spark, folder).collect()
    assert len(got) == len(want) and {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "PIECE", 3)
    queries.ship(spark)
    rows = [
        (1, 0, "system", "Hi."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."), (1, 5, "user", "Why?"), (1, 6, "assistant", "cut"),
        (2, 0, None, None), (2, 1, "", "x."), (2, 2, "tool", "y!"), (3, None, "user", "first."), (3, 4, "assistant", "last."),
        (None, 1, "user", "a."), (None, None, "assistant", "b."), (4, 7, "user", "\t\n"), (5, 3, "user", "same."), (5, 3, "user", "same."),
        (6, -4, "assistant", "é漢🙂."), (6, 9, "user", "x " * 50_000),
    ]
    rows += [(7, i, "user" if i % 3 else "assistant", f"t{i // 40}.") for i in range(200)]
    data = [(*r, "clash", 1) for r in rows]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, audit string, cost int").repartition(5)
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t, " " if role is None else role, " " if text is None else text))
    want = {c: summary(in_turn_order(ts)) for c, ts in groups.items()}
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turn_repair.repair(turns).collect()}
    assert got == want
    lines = defaultdict(list)
    for r in turn_repair.repaired_turns(turns).orderBy("conv_id", "position").collect():
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_dropped_and_missing_rows(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    none = turns.withColumn("copies", (turns.conv_id == 2).cast("int"))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turn_repair.repair(none, "copies").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty) and got[2][5:7] == (0, "KK")
    assert turn_repair.repair(turns.limit(0)).collect() == [] and turn_repair.repaired_turns(turns.limit(0)).collect() == []


def test_order_of_equal_turns_does_not_depend_on_the_layout(spark):
    rows = [(c, 0, role, text) for c in range(5) for role, text in (("user", "a."), ("assistant", "b."), ("user", "c"), ("user", "a."))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    results = [{tuple(r) for r in turn_repair.repair(t).collect()} for t in (turns.coalesce(1), turns.repartition(7))]
    assert results[0] == results[1]

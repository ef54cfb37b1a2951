import hashlib
import itertools
import random
import re
import zlib

import pytest

from municare.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, place int, copy int, blank string"


def cheapest(rows):
    """(cost, audit, turns) of all ways to edit rows of (role, text, doomed, truncated)."""
    best = None
    for inserted in itertools.product(range(3), repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            if any(e != "D" and r[2] for e, r in zip(edits, rows)):
                continue
            audit = "".join("I" * k + e for k, e in zip(inserted, edits)) + "I" * inserted[-1]
            cost = 5 * sum(inserted) + sum(2 if e == "D" else (e == "R") + 5 * r[3] for e, r in zip(edits, rows))
            if best and (cost, audit) >= best[:2]:
                continue
            turns = []
            for k, e, (role, text, _, _) in zip(inserted, edits, rows):
                turns += [(None, "")] * k + ([] if e == "D" else [(role if e == "K" else None, text)])
            turns += [(None, "")] * inserted[-1]
            free = [i for i, t in enumerate(turns) if t[0] is None]
            for roles in itertools.product(("user", "assistant"), repeat=len(free)):
                full = list(turns)
                for i, role in zip(free, roles):
                    full[i] = (role, full[i][1])
                if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in full)):
                    best = (cost, audit, full)
    return best


def searched(rows):
    told, out = repair._Conversation(1), []
    for role, text, doomed, truncated in rows:
        out += told._take(told.search.push(role, text, doomed, truncated))
    turns, cost = told.end()
    return (cost, "".join(told.audit), out + turns), told


def test_search_equals_all_ways():
    rng = random.Random(5)
    for _ in range(250):
        rows = [
            (rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "ass", "uu"]), str(i), rng.random() < 0.15, rng.random() < 0.2)
            for i in range(rng.choice([0, 1, 2, 2, 3, 3]))
        ]
        (cost, audit, turns), told = searched(rows)
        assert (cost, audit, turns) == cheapest(rows), rows
        assert told.sha.hexdigest() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def whole_strings(rows):
    """The same by keeping the whole edits of every state."""
    best = {repair.NOTHING: (0, "")}
    for role, _, doomed, truncated in rows:
        after = {}
        for state, (cost, audit) in best.items():
            for mid, n in repair._inserted(state):
                so_far, edits = cost + 5 * n, audit + "I" * n
                ways = [(mid, so_far + 2, edits + "D")]
                if not doomed:
                    kept = mid if role == "" else repair.SAYS.get((mid, role[:1]))
                    ways += [(kept, so_far + 5 * truncated, edits + "K")] if kept is not None else []
                    ways.append((repair._spoken(mid), so_far + 1 + 5 * truncated, edits + "R"))
                for end, *way in ways:
                    after[end] = min(after.get(end, (10**9, "")), tuple(way))
        best = after
    return min((cost + 5 * n, audit + "I" * n) for state, n in repair._LAST if state in best for cost, audit in [best[state]])


@pytest.mark.parametrize("roles", [["user", "assistant"], ["system", "user", "assistant", "tool", ""], ["tool"], ["tool", "user"], ["system"]])
def test_long_conversations_and_ties(roles):
    rng = random.Random(str(roles))
    for n in (5, 40, 120):
        for _ in range(12):
            rows = [(rng.choice(roles), str(i), rng.random() < 0.1, rng.random() < 0.1) for i in range(n)]
            assert searched(rows)[0][:2] == whole_strings(rows)


def test_the_tree_holds_the_unresolved_stretch_only():
    rng = random.Random(1)
    told, most = repair._Conversation(1), 0
    for i in range(20_000):
        told._take(told.search.push(rng.choice(["user", "assistant"]), "x", rng.random() < 0.1, rng.random() < 0.1))
        most = max(most, told.search.held)
    told.end()
    assert most < 500 and told.search.held < 500


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        order = (turn is not None, turn or 0)
        role, text = "user" if fault == 4 else " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, order, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: r[2:])
        blank = repeat = truncated = 0
        seen, judged = set(), []
        for _, _, _, role, text in mine:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            empty, again, cut = said == "", (role, text) in seen, said[-1:] not in tuple(".!?")
            seen.add((role, text))
            blank, repeat, truncated = blank + empty, repeat + (again and not empty), truncated + (cut and not again and not empty)
            judged.append((role, text, empty or again, cut and not (empty or again)))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[3][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        (cost, audit, turns), _ = searched(judged)
        told = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.append((conv, gaps, blank, repeat, truncated, illegal, cost, audit, told))
    return sorted(out, key=str)


def summed(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 0, "") for r in rows], SCHEMA).repartition(4)
    found = repair.damaged(frame)
    from pyspark.sql import functions as F

    found = repair.judged(found, "conv_id", "turn", "role", "text", F.col("present"), copy=F.col("copy"))
    return sorted((tuple(r)[:-1] for r in repair.summaries(found).collect()), key=str)


def test_summaries_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No", "Why? \n", " ", "", "é!", "same.", f"own {conv} {turn}."])
            rows.append((conv, turn + rng.choice([0, 0, 3]), rng.choice(["system", "user", "assistant", "tool"]), text))
    assert summed(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = "word " * 100_000 + "."
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "b."), (1, None, "user", "b."), (1, 2, None, "c."), (1, 3, "", "d."),
            (2, 1, "user", None), (3, 1, "user", long), (3, 2, "assistant", long), (4, -5, "system", "x."), (4, 5, "user", "\x85."), (4, 7, "assistant", "y　")]
    assert summed(spark, rows) == brute(rows)
    assert summed(spark, []) == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert summed(spark, [(dropped, 1, "user", "x.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_one_hot_conversation_and_its_repaired_turns(spark):
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"{i} said.") for i in range(3_000)] + [(k, 1, "user", "x.") for k in range(2, 40)]
    frame = spark.createDataFrame([(*r, 0, 0, "") for r in rows], SCHEMA)
    turns = [(r["conv_id"], r["place"], r["role"], r["text"]) for r in repair.repair(frame).collect()]
    want = []
    for conv in sorted({r[0] for r in rows}):
        (_, _, said), _ = searched([(r[2], r[3], False, False) for r in rows if r[0] == conv])
        want += [(conv, i, role, text) for i, (role, text) in enumerate(said)]
    assert sorted(turns) == want
    assert frame.count() > 3_000 and repair.repair(frame.limit(0)).count() == 0

import random
import re

import pytest

from municare.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, row int, gram string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for i, text in items:
        words = WORD.findall(lower(text))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[k : k + 10]), set()).add("" if i is None else str(i))
    out = []
    for i, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(words[k : k + size])]
        out.append((i, len(words), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


def told(spark, docs, items, **limits):
    frame = spark.createDataFrame([(i, t, 0, 0, "", 0) for i, t in docs], "doc_id long, text string, row int, n_words int, gram string, low int")
    bench = spark.createDataFrame([(i, t, 0, "") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in decontaminate.judge(frame, bench, **limits).collect()), key=str)


def case(seed, shortest=1):
    rng = random.Random(seed)
    pool = ["a", "B", "é", "漢字", "x1", "the", "THE", "É"]
    say = lambda n: rng.choice([" ", ", ", "\n", "-", "\x00", "\x7f"]).join(rng.choice(pool) for _ in range(n))
    items = [(rng.randint(0, 30), say(rng.choice([shortest, shortest + 1, 9, 10, 11, 25]))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [say(rng.randint(0, 12)) for _ in range(3)] + [rng.choice(items)[1].swapcase() for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        docs.append((i, rng.choice([" ", "!", " \t"]).join(parts)))
    return docs, items


@pytest.mark.parametrize("seed, shortest", [(0, 7), (1, 10), (2, 1), (3, 4)])
def test_equals_brute_force(spark, seed, shortest):
    docs, items = case(seed, shortest)
    want = brute(docs, items)
    assert told(spark, docs, items) == want
    assert told(spark, docs, items, most_windows=5) == want  # several passes
    assert told(spark, docs, items, most_bytes=100) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7} v{i}" for i in range(60_000))
    items = [(None, " ".join(f"w{i % 7} v{i}" for i in range(100, 130))), (3, None), (4, ""), (5, " .,! "), (6, "one two"), (6, "One, TWO"), (7, "one two")]
    docs = [(1, None), (2, ""), (3, "\n.\t"), (None, "one two three"), (None, "one two three"), (4, long), (5, "one"), (5, "ONE-two one two")]
    got = told(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[4] for r in got if r[0] == 4] == [[""]] and [r[2:5] for r in got if r[0] is None] == [(2, 2, ["6", "7"])] * 2
    assert told(spark, [], items) == [] and told(spark, docs, []) == brute(docs, [])


def test_spans_and_documents_are_removed(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short one")]
    rows = [
        (1, "Keep this. ALPHA, beta gamma delta epsilon zeta eta theta iota kappa lambda! and this."), (2, "nothing here, at all."),
        (3, "A Short one; a short one."), (3, "A Short one; a short one."), (4, None), (5, "short one"),
        (6, "beta gamma delta epsilon zeta eta theta iota kappa"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, __gone string").repartition(3)
    bench = spark.createDataFrame([(i, t, 0, "") for i, t in items], ITEMS)
    out = decontaminate.decontaminate(docs, bench)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == [(1, "Keep this! and this."), (2, rows[1][1]), (3, "A; a."), (3, "A; a."), (4, None), (5, ""), (6, rows[6][1])]
    left = decontaminate.decontaminate(docs, bench, remove="documents")
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 6]
    assert not decontaminate.judge(out, bench).filter("contaminated").count()


def test_no_python_in_the_plan(spark):
    docs, items = case(1)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = decontaminate.judge(frame, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan

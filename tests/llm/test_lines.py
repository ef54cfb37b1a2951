import random

import pytest

from municare.llm import lines


def brute(docs, least):
    """Rows (doc_id, text left) by looking at every run of lines."""
    split = {i: [x for x in (t or "").split("\n")] for i, t in docs}
    worded = {i: [k for k, x in enumerate(s) if x.split()] for i, s in split.items()}
    size = {i: [len(split[i][k].split()) for k in worded[i]] for i in split}
    first, gone = {}, {i: set() for i in split}
    for i in sorted(split):
        n = len(worded[i])
        runs = set()
        for a in range(n):
            ends = [b for b in range(a, n) if sum(size[i][a : b + 1]) >= least]
            runs |= {(a, ends[0])} if ends else set()
        for b in range(n):
            starts = [a for a in range(b + 1) if sum(size[i][a : b + 1]) >= least]
            runs |= {(starts[-1], b)} if starts else set()
        for a, b in sorted(runs):
            run = tuple(split[i][k] for k in worded[i][a : b + 1])
            if run in first:
                j, c, d = first[run]
                low = max(a, d + 1) if j == i else a
                gone[i] |= {worded[i][k] for k in range(low, b + 1)}
            else:
                first[run] = (i, a, b)
    out = {}
    for i, t in docs:
        left = [x for k, x in enumerate(split[i]) if k not in gone[i]]
        out[i] = t if not gone[i] else "\n".join(left) if any(x.split() for x in left) else ""
    return out, {i: len(g) for i, g in gone.items()}


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(documents, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 1, 2, 4, 7, 12]))) for _ in range(14)]
    runs = [[rng.choice(pool) for _ in range(rng.randint(2, 12))] for _ in range(5)]
    docs = []
    for i in range(40):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choice(runs)[rng.randint(0, 2) :] if rng.random() < 0.6 else [f"own {i} {rng.random()}"]
            text += ["", "  "][: rng.randint(0, 2)]
        docs.append((i, "\n".join(text)))
    docs.append((99, "\n".join(["x"] * 50)))
    want, deleted = brute(docs, 10)
    got = {r["doc_id"]: r for r in lines.line_dedup(documents(docs), min_words=10).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert {i: r["n_deleted"] for i, r in got.items()} == deleted


def test_whole_passage_goes_from_later_documents(documents):
    passage = "\n".join([" ".join(f"p{i}" for i in range(k, k + 14)) for k in (0, 14, 28, 42)] + ["tail one", "tail two"])
    docs = [(1, f"begin\n{passage}\nend"), (2, f"other\n{passage}\nfinish"), (3, passage), (4, "tail one\ntail two")]
    got = {r["doc_id"]: r["text"] for r in lines.line_dedup(documents(docs)).collect()}
    assert got == {1: docs[0][1], 2: "other\nfinish", 3: "", 4: "tail one\ntail two"}


def test_odd_rows(odd):
    got = lines.line_dedup(odd)
    assert got.columns[: len(odd.columns)] == odd.columns
    rows = [(r["doc_id"], r["text"], r["n_deleted"]) for r in got.collect()]
    assert len(rows) == odd.count()
    by_id = {i: (t, n) for i, t, n in rows}
    assert by_id[1] == (None, 0) and by_id[2] == ("", 0) and by_id[3] == (" \n\t ", 0)
    assert by_id[6] == ("", 1) and len(by_id[5][0]) > 100_000
    assert by_id[7][1] == 1 and by_id[8] == ("", 1)
    assert sum(1 for i, t, _ in rows if i == 4 and t == "one two") == 2


def test_no_rows(documents):
    assert lines.line_dedup(documents([])).count() == 0

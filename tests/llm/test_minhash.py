import random

import numpy as np
import pytest

from municare.llm import minhash
from municare.llm.components import components
from municare.llm.shingles import Shingler


def sets_of(docs):
    out = {}
    for i, text in docs:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def brute(docs):
    sets = sets_of(docs)
    group = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while True:
        before = dict(group)
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
        if before == group:
            return {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


def family(rng, start, count, edits):
    base = [f"w{rng.randint(0, 3000)}" for _ in range(120)]
    out = []
    for k in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        out.append((start + k, (" ".join(words)).title() if k % 3 else " \n ".join(words)))
    return out


@pytest.mark.parametrize("seed, few", [(0, 16), (1, 1), (2, 2), (3, 1)])
def test_equals_brute_force(documents, monkeypatch, seed, few):
    monkeypatch.setattr(minhash, "FEW", few)
    rng = random.Random(seed)
    docs = []
    for f in range(12):
        docs += family(rng, 100 * f, rng.randint(1, 14), rng.choice([0, 2, 4, 7]))
    # A chain: every text is like the next one, the ends are not.
    words = [f"c{k}" for k in range(100)]
    for k in range(12):
        docs.append((5000 - k, " ".join(words)))
        words[8 * k : 8 * k + 4] = [f"n{k}{j}" for j in range(4)]
    # Many copies around the limit: most are like the first, few are like each other.
    base = [f"b{k}" for k in range(130)]
    for k in range(40):
        words = list(base)
        for _ in range(rng.randint(2, 9)):
            words[rng.randrange(130)] = f"v{rng.randint(0, 5)}"
        docs.append((6000 + k, " ".join(words)))
    docs += [(7000, "a b c"), (7001, "A  B c"), (7002, "a b"), (7003, None), (7004, ""), (7005, "\t\n")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(documents(docs)).collect()}
    assert got == brute(docs)


def test_copies_and_strangers_give_pairs_in_proportion(documents, monkeypatch, spark):
    """Near copies that share buckets with a few strangers: what is listed grows with the copies."""
    listed = []
    real = minhash._listed

    def counted(*a, **b):
        out = real(*a, **b)
        listed[-1] += out.count()
        return out

    monkeypatch.setattr(minhash, "_listed", counted)
    for n in (60, 240):
        rng = random.Random(n)
        base = [f"b{k}" for k in range(160)]
        docs = []
        for k in range(n):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(160)] = f"v{rng.randint(0, 10**6)}"
            docs.append((k, " ".join(words)))
        for k in range(3):  # alike, but below the threshold
            docs.append((10_000 + k, " ".join(base[: 100 + k] + [f"s{k}{j}" for j in range(60)])))
        listed.append(0)
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(docs)).collect()}
        assert got == {i: c for i, (_, c, _) in brute(docs).items()}
    assert listed[1] <= 8 * max(listed[0], 60)


def test_estimates_the_jaccard_coefficient():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for share in (0.2, 0.5, 0.8):
        both = int(2000 * 2 * share / (1 + share))
        a, b = pool[:2000], pool[2000 - both : 4000 - both]
        agree = (minhash.signature(a, 1024) == minhash.signature(b, 1024)).mean()
        assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.06
    one = Shingler()(b"a b c d e f")
    assert (minhash.signature(one, 8) == minhash.signature(one[::-1].copy(), 8)).all()


def test_odd_rows(odd, documents):
    rows = [tuple(r) for r in minhash.near_duplicates(odd).collect()]
    assert len(rows) == odd.count()
    got = {r[0]: r for r in rows}
    assert got[1] == (1, 0, 1, True) and got[2] == (2, 0, 2, True) and got[3] == (3, 0, 3, True)
    assert got[6][2:] == (5, False) and got[5][1] > 1000
    assert sorted(r for r in rows if r[0] == 4) == [(4, 1, 4, True)] * 3
    assert [r for r in rows if r[0] is None] == [(None, 1, None, True)] * 2
    assert got[8][2] == 7  # a line, and the same line twice
    assert minhash.near_duplicates(documents([])).count() == 0


def test_components_of_chains_stars_and_no_links(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(10, 40)] + [(7, 7), (None, 3), (41, 39)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {k: 5 for k in range(10, 40)} | {5: 5, 41: 5}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_that_repeat_with_other_texts(spark, documents):
    import corpus_pipeline

    texts = {n: " ".join(f"{n}{k}" for k in range(80)) for n in "abc"}
    near = {n: t + " tail" for n, t in texts.items()}
    rows = [(5, texts["a"]), (5, texts["b"]), (5, texts["b"]), (7, near["a"]), (8, near["b"]), (1, texts["c"]), (7, near["c"]), (9, near["b"] + " x")]
    want = [(1, 1, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 1, False), (7, 5, False), (8, 5, False), (9, 5, False)]
    got = minhash.near_duplicates(documents(rows)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == want
    # A clean text stays beside a duplicate of the same id; of two near copies under one id one stays.
    docs = documents([(1, texts["a"]), (3, near["a"]), (3, texts["b"]), (4, texts["c"]), (4, near["c"]), (None, texts["a"])])
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert {(1, texts["a"]), (3, texts["b"]), (None, texts["a"])} < set(left) and len(left) == 4
    assert [i for i, t in left if t in (texts["c"], near["c"])] == [4]

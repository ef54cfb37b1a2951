import random

import pytest

from municare.llm import mixing


def slow_targets(sizes, weights, share, repeats):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = (budget - sum(out.values())) / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > repeats * sizes[s]}
        out |= {s: repeats * sizes[s] for s in full}
        free -= full
        if not full:
            return out | {s: weight[s] * level for s in free}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_rounds_of_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice(["a", "B", "é", "z", "zz", "\U0001f600", "￮", "s1", "s10", None]): rng.choice([0, 5, 100, 1000, 7000]) for _ in range(8)}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame, (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(slow_targets(sizes, (5, 2, 1), 1.5, 2))


def mixed(docs):
    return [r.asDict() for r in mixing.mix(docs).collect()]


def test_shares_bounds_and_reruns(documents):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    got = mixed(documents(rows))
    assert len(got) == 600
    words, taken, target = {}, {}, {}
    for r in got:
        assert r["times"] in (0, 1, 2)
        words[r["source"]] = words.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["times"]
        target[r["source"]] = r["target"]
    want = slow_targets(words, (5, 2, 1), 1.5, 2)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 80 for s in want)
    again = mixed(documents(rows[::-1]))
    key = lambda r: r["doc_id"]
    assert sorted(got, key=key) == sorted(again, key=key)
    # No document comes again before all of its source came once.
    for s in want:
        times = {r["times"] for r in got if r["source"] == s}
        assert max(times) - min(times) <= 1


def test_finish_times_order_the_mix(documents):
    rows = [(i, "w", "a" if i < 90 else "b") for i in range(100)]
    got = mixing.mix(documents(rows), weights=(1, 1), share=1.0, repeats=1)
    by = {(r["source"], r["target"]) for r in got.collect()}
    assert by == {("a", 90.0), ("b", 10.0)}
    assert got.agg({"times": "sum"}).first()[0] == 100


def test_odd_rows(odd, documents):
    got = mixed(odd)
    assert len(got) == odd.count()
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    out = mixing.mixture(odd)
    assert out.columns == odd.columns and out.count() >= 1
    assert mixed(documents([])) == []
    assert mixing.mixture(documents([])).count() == 0
    assert [r["times"] for r in mixed(documents([(1, None), (2, "")]))] == [2, 2]


def test_mixture_repeats_documents(documents):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 30 + ["b"] * 10 + ["c"] * 10)]
    docs = documents(rows)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(docs).collect()}
    out = [r["doc_id"] for r in mixing.mixture(docs).collect()]
    assert {i: out.count(i) for i in times} == times

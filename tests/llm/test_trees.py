import random

import numpy as np

from municare.llm import trees

LABELS = "doc_id long, quality int, toxic int, kept int"


def slow_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_counts_equal_brute_force():
    rng = random.Random(5)
    alphabet = ["a", "b", "é", "漢字", "x#", "<|>", "\u00a0", "\u2028z", "\x1c", "\x85"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) + rng.choice([" ", "\n", "\t", "  ", "\n\n", "\x0b"]) for _ in range(rng.randint(0, 40)))
        assert trees.statistics(text.encode())[0] == slow_counts(text)
    assert trees.statistics(None)[0] == (0, 0, 0, 0, 0)


def test_forest_learns_and_stays_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.05 * rng.normal(size=3000)) < 0.6).astype(float)
    forest = trees.fit_forest(x, y, np.array([-1, 0, 0]))
    assert ((forest.probability(x) >= 0.5) == y).mean() > 0.93
    grid = np.repeat(rng.random((50, 1, 3)), 200, 1)
    grid[:, :, 0] = np.linspace(0, 1, 200)
    scores = forest.margin(grid.reshape(-1, 3)).reshape(50, 200)
    assert (np.diff(scores, axis=1) <= 1e-12).all()
    # One document walks the flat arrays as a recursive walk would.
    def walk(node, row):
        if forest.left[node] == node:
            return forest.value[node]
        return walk(forest.left[node] if row[forest.feature[node]] <= forest.cut[node] else forest.right[node], row)

    assert np.allclose(forest.margin(x[:5]), [forest.base + sum(walk(r, row) for r in forest.roots) for row in x[:5]])


def test_rules_and_trees_judge(spark, documents):
    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdeo") for _ in range(rng.randint(2, 8))) for _ in range(n))
    good = [(i, words(rng.randint(60, 200))) for i in range(150)]
    bad = [(1000 + i, " ".join(w + "###" for w in words(rng.randint(60, 200)).split())) for i in range(60)]
    repeat = [(2000, "a b c " * 40), (2001, words(49)), (2002, None), (2002, None), (None, words(80))]
    docs = documents(good + bad + repeat)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    labels = spark.createDataFrame([(i, 1, 0, 0) for i, _ in good[:100]] + [(i, 0, 0, 0) for i, _ in bad[:40]] + [(None, 0, 0, 0), (5, None, 0, 0), (6, 1, 0, 0)], LABELS)
    got = [(r["doc_id"], r["base_failed"], r["kept"]) for r in trees.quality_rules(docs, labels).collect()]
    assert len(got) == len(good + bad + repeat)
    kept = {i: (f, k) for i, f, k in got}
    assert all(kept[i] == (False, True) for i, _ in good) and all(kept[i] == (False, False) for i, _ in bad)
    assert all(kept[i] == (True, False) for i in (2000, 2001, 2002)) and kept[None] == (False, True)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([], LABELS)
    rows = trees.quality_rules(odd, labels).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"]: r["kept"] for r in rows if r["doc_id"]} == {1: False, 2: False, 3: False, 4: False, 5: True, 6: True, 7: False, 8: True, 9: False}
    assert trees.quality_rules(odd.limit(0), labels).count() == 0
    one = spark.createDataFrame([(5, 1, 0, 0), (5, 1, 0, 0), (6, 1, 0, 0)], LABELS)
    assert trees.quality_rules(odd, one).filter("kept").count() == 3


def test_kept_documents_keep_their_columns(spark, odd):
    labels = spark.createDataFrame([], LABELS)
    out = trees.kept_documents(odd, labels)
    assert out.columns == odd.columns and sorted(r["doc_id"] for r in out.collect()) == [5, 6, 8]

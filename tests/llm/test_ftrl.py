import random
import zlib

import numpy as np

from municare.llm import ftrl

LABELS = "doc_id long, quality int, toxic int, score int"


def corpus(documents, n=400):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 8)))
    rows, quality = [], {}
    for i in range(n):
        bad = rng.random() < 0.3
        words = [word() for _ in range(rng.randint(20, 120))]
        if bad:
            words = rng.choice([[w + "%%%" for w in words], [w.upper() + "!!" for w in words], [w for w in words[:9] for _ in range(9)]])
        rows.append((i, " ".join(words)))
        quality[i] = int(not bad)
    return documents(rows), quality


def test_held_out_accuracy_and_folds(spark, documents):
    docs, quality = corpus(documents)
    labels = spark.createDataFrame([(i, q, 0, 0) for i, q in quality.items()], LABELS)
    got = ftrl.classify(docs, labels).collect()
    held = {r["doc_id"]: r for r in got if r["held_out"]}
    assert set(held) == {i for i in quality if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r["predicted"] == quality[i] for i, r in held.items()]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_held_out_labels_teach_nothing(spark, documents):
    docs, quality = corpus(documents, 120)
    labels = [(i, q, 0, 0) for i, q in quality.items()]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t, s) for i, q, t, s in labels]
    score = lambda rows: sorted((r["doc_id"], r["score"]) for r in ftrl.classify(docs, spark.createDataFrame(rows, LABELS)).collect())
    assert score(labels) == score(turned)


def test_update_equals_the_formula():
    examples = [(np.array([0, 2]), np.array([0.6, 0.8]), 1), (np.array([1, 2]), np.array([0.8, 0.6]), 0)]
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        if abs(z[i]) <= ftrl.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * ftrl.L1) / ((ftrl.BETA + n[i] ** 0.5) / ftrl.ALPHA + ftrl.L2)

    for _ in range(3):
        for columns, values, y in examples:
            x = dict(zip([*columns, 3], [*values, 1.0]))
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / ftrl.ALPHA * w[i]
                n[i] += g * g
    assert np.allclose(ftrl.learn(examples, 3, 3), [weight(i) for i in range(4)])


def test_odd_rows(spark, odd):
    none = spark.createDataFrame([], LABELS)
    got = ftrl.classify(odd, none).collect()
    assert len(got) == odd.count() and {r["score"] for r in got} == {0.5}
    some = spark.createDataFrame([(4, 1, 0, 0), (4, 0, 0, 0), (5, 1, 0, 0), (None, 0, 0, 0), (8, None, 0, 0)], LABELS)
    rows = ftrl.classify(odd, some).collect()
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert not [r for r in rows if r["doc_id"] is None and r["held_out"]]
    assert ftrl.classify(odd.limit(0), some).count() == 0

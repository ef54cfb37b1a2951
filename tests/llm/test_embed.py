import numpy as np
import pytest

from municare.llm import embed

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cell int, kept string"


def brute(rows):
    ids = [i for i, _ in rows]
    units = [None if v is None else np.asarray(v, float) for _, v in rows]
    fine = [k for k, v in enumerate(units) if v is not None and len(v) and np.isfinite(v).all() and (v != 0).any()]
    links = {i: 0 for i in ids}
    group = {i: i for i in ids}
    pairs = []
    for a in fine:
        for b in fine:
            if a < b and units[a] @ units[b] / np.sqrt((units[a] @ units[a]) * (units[b] @ units[b])) >= 0.95:
                links[ids[a]] += 1
                links[ids[b]] += 1
                pairs.append((ids[a], ids[b]))
    while True:
        before = dict(group)
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
        if before == group:
            return {i: (links[i], group[i], group[i] == i) for i in ids}


def clustered(seed, count, width=8):
    rng = np.random.default_rng(seed)
    out, centre = [], rng.normal(size=width)
    for i in range(count):
        if rng.random() < 0.2:
            centre = rng.normal(size=width)
        v = centre + rng.normal(size=width) * rng.choice([0, 0.02, 0.1, 0.2])
        out.append((i * 3, [float(np.float32(x)) for x in v]))
    return out


@pytest.mark.parametrize("cell, block", [(4096, 8192), (25, 8192), (40, 11)])
def test_equals_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embed, "CELL_ROWS", cell)
    monkeypatch.setattr(embed, "BLOCK", block)
    monkeypatch.setattr(embed, "GUEST_BLOCK", 3 * block)
    rows = clustered(cell, 300)
    hot = np.random.default_rng(1).normal(size=8)
    rows += [(5000 + i, [float(np.float32(x)) for x in hot + 0.01 * np.sin(i + np.arange(8))]) for i in range(80)]
    rows += [(9000, [0.0] * 8), (9001, None), (9002, [1.0, float("nan")] + [0.0] * 6), (9003, []), (9004, [float("inf")] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 0, 0, "") for i, v in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed.near_duplicates(frame).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0]), (3, [None, 1.0]), (4, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, 0, 0, "") for i, v in rows], SCHEMA)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed.near_duplicates(frame).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 0, None, True)]


def test_no_rows(spark):
    assert embed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, 1, 0, 0, "")], SCHEMA)
    assert [tuple(r) for r in embed.near_duplicates(none).collect()] == [(1, 0, 1, True)]


def test_ids_that_repeat_with_other_vectors(spark):
    vectors = [(1, [1.0, 0.0, 0.0]), (1, [0.99, 0.1, 0.0]), (2, [0.99, 0.0, 0.1]), (1, [0.0, 1.0, 0.0]), (3, [0.0, 0.99, 0.1]), (4, [0.0, 0.0, 1.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed.near_duplicates(frame).collect())
    assert [r[:3] for r in got] == [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1), (4, 0, 4)]
    assert [r[3] for r in got] == [r[0] == r[2] for r in got]


def test_single_precision_only_chooses_candidates(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64))
    y = np.concatenate([x[:200] + 0.33 * rng.normal(size=(200, 64)), rng.normal(size=(100, 64))])
    x, y = (v / np.sqrt((v * v).sum(1))[:, None] for v in (x, y))
    want = set(zip(*np.nonzero(x @ y.T >= 0.95)))
    for finished in (50_000, 0):
        monkeypatch.setattr(embed, "_FINISHED", finished)
        assert set(zip(*embed._pairs(x, y, x.astype(np.float32), y.astype(np.float32), 0.95))) == want
    assert 20 < len(want) < 200

"""Stages 1 to 4 of the pipeline against brute force, each on what the one before kept."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from test_lines import brute as brute_lines
from test_minhash import brute as brute_near
from test_mixing import slow_targets
from test_trees import slow_counts

from municare.llm import mixing, trees
from municare.session import shared_folder

POOL = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ane", "ore", "ist", "ung", "ell", "omi")]


def sentence(rng, count):
    return " ".join(rng.choice(POOL) + str(rng.randint(0, 400)) for _ in range(count))


@pytest.fixture(scope="module")
def corpus():
    """Clean texts, junk, short ones, near copies, exact copies, and a passage that many share."""
    rng = random.Random(11)
    passage = "\n".join(sentence(rng, 20) for _ in range(4))
    rows, quality = [], []
    for i in range(160):
        kind = rng.choice(["clean", "clean", "clean", "junk", "short", "near", "copy", "shared"])
        text = "\n".join(sentence(rng, rng.randint(12, 30)) for _ in range(rng.randint(3, 7)))
        if kind == "junk":
            text = " ".join(rng.choice(["###", "win", "$$$", "click"]) for _ in range(rng.randint(60, 200)))
        elif kind == "short":
            text = sentence(rng, rng.randint(0, 49))
        elif kind in ("near", "copy") and rows:
            base = rng.choice(rows)[1] or ""
            words = base.split(" ")
            if kind == "near" and len(words) > 60:
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == "shared":
            text = f"{text}\n{passage}"
        rows.append((i, text, rng.choice("aab")))
        quality.append((i, int(kind not in ("junk", "short")), 0))
    # Nulls, repeated rows, and a text that a later one takes all lines from.
    rows += [(200, None, "a"), (201, "", None), (202, passage, "b"), (203, rows[0][1], "b"), (203, rows[0][1], "b")]
    return rows, quality


def content(frame):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in frame.collect())


def run(spark, docs, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns
    path = shared_folder(spark, name)
    out.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_equal_brute_force(spark, documents, corpus):
    rows, quality = corpus
    folder = shared_folder(spark, "sf")
    spark.createDataFrame(quality, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = documents(rows)
    before = content(docs)

    # 1: the base rules by hand; of the rest the trees drop what they call poor.
    after = run(spark, docs, folder, "quality_rules")
    verdict = {(r["doc_id"], r["n_words"]): (r["base_failed"], r["kept"]) for r in trees.quality_rules(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    want = Counter()
    for (i, text, source), n in before.items():
        words, _, _, _, repeated = slow_counts(text)
        failed = words < 50 or 100 * repeated > 50 * words
        assert verdict[i, words][0] == failed and not (failed and verdict[i, words][1])
        if verdict[i, words][1]:
            want[i, text, source] += n
    assert content(after) == want
    clean = {i for i, q, _ in quality if q}
    assert len({i for i, _, _ in want} & clean) > 0.9 * len({i for i, t, _ in rows if i in clean and slow_counts(t)[0] >= 50})

    # 2: later copies of runs of 50 words go, and documents that have no worded line left.
    docs, after = after, run(spark, after, folder, "line_dedup")
    left, gone = brute_lines(sorted({(i, t) for i, t, _ in content(docs)}), 50)
    want = Counter()
    for (i, text, source), n in content(docs).items():
        if not (gone[i] and not left[i].split()):
            want[i, left[i], source] += n
    assert content(after) == want and sum(want.values()) < docs.count()
    assert all(t.split() for _, t, _ in want)

    # 3: the smallest id of each component stays.
    docs, after = after, run(spark, after, folder, "minhash_near_dedup")
    component = brute_near([(i, t) for i, t, _ in content(docs)])
    want = Counter({row: n for row, n in content(docs).items() if component[row[0]][2]})
    assert content(after) == want and len(want) < len(content(docs))

    # 4: queues by finish time, in the order of the mix, until the budget is reached.
    docs, after = after, run(spark, after, folder, "mix_sources")
    kept = list(content(docs))
    size = {i: len(t.split()) for i, t, _ in kept}
    source = {i: s for i, _, s in kept}
    total = Counter()
    for i in size:
        total[source[i]] += size[i]
    target = slow_targets(total, mixing.WEIGHTS, mixing.SHARE, mixing.REPEATS)
    from pyspark.sql import functions as F

    order = {r[0]: r[1] for r in spark.createDataFrame(list(size.items()), "doc_id long, size long").select("doc_id", F.xxhash64(F.lit(8), "doc_id", "size")).collect()}
    finish = []
    for s in total:
        served = 0
        for again in range(mixing.REPEATS):
            for i in sorted((i for i in size if source[i] == s), key=order.get):
                served += size[i]
                finish.append((served / target[s], again, order[i], i))
    want, taken = Counter(), 0
    for _, _, _, i in sorted(finish):
        taken += size[i]
        if taken <= sum(target.values()):
            want[i] += 1
    assert Counter(r["doc_id"] for r in after.collect()) == want


def test_the_chain_takes_odd_rows(spark, documents, odd):
    folder = shared_folder(spark, "sf")
    spark.createDataFrame([(5, 1, 0), (6, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for docs in (odd, documents([])):
        path = f"{shared_folder(spark, 'in')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
            if name != "bpe_encode":
                path = shared_folder(spark, name)
                docs.write.parquet(path)
                docs = spark.read.parquet(path)
        assert docs.columns[:2] == ["doc_id", "n_tokens"] and docs.count() >= 0

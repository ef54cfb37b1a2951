import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from municare.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def changed(row):
    hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
    if not hit or row["text"] is None:
        return row
    return {**row, "text": "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])}


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for members in groups.values():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), leaf(changed(r))))
    trees = [levels([leaf(r) for r in groups[g]]) for g in langs]
    top = levels([t[-1][0] for t in trees]) if trees else [[None]]
    out = []
    for g, (lang, tree) in enumerate(zip(langs, trees)):
        for i, row in enumerate(groups[lang]):
            folded, siblings = leaf(changed(row)), ""
            for above, at in ((tree, i), (top, g)):
                for level in above[:-1]:
                    first = at // 8 * 8
                    run = level[first : first + 8]
                    siblings += "".join(run[: at - first] + run[at - first + 1 :])
                    folded = h("".join(run[: at - first] + [folded] + run[at - first + 1 :]))
                    at //= 8
            out.append((row["doc_id"], leaf(row), tree[-1][0], top[-1][0], h(siblings), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proofs(docs):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(hit, merkle.lowered("text")).otherwise(F.col("text"))
    told = merkle.prove(merkle.build(docs, COLUMNS, "lang", "doc_id", {"text": claim}))
    text = lambda b: None if b is None else bytes(b).hex()
    return sorted(
        ((r["doc_id"], *(text(r[c]) for c in ("leaf", "subroot", "root", "proof", "folded_root")), r["verified"]) for r in told.collect()),
        key=str,
    )


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf int, g int, at int, level int, place int"
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 0, 0, 0, 0, 0) for r in rows], schema)


# Numbers around whole runs, more groups than a run, lone leaves, and a hot group.
@pytest.mark.parametrize("sizes", [[1], [2, 1], [8, 9, 64, 65, 1], [1] * 8, [3] * 9, [200] + [1] * 20, [513]])
def test_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    names = [None, "", "a", "B", "é", "漢"] + [f"l{i}" for i in range(30)]
    rows = []
    for name, size in zip(names[-len(sizes) :] if len(sizes) > 9 else names, sizes):
        rows += [
            {"doc_id": rng.randint(-50, 10**6), "text": rng.choice(["Some TEXT é", "lower", "", None, f"X{rng.random()}"]), "lang": name,
             "source": rng.choice(["s", None, "a:b"]), "n_chars": rng.choice([None, 0, 12])} for _ in range(size)
        ]
    got = proofs(frame(spark, rows).repartition(5))
    assert got == brute(rows)
    assert any(not r[-1] for r in got) or len(rows) < 9


def test_odd_rows(spark, odd):
    rows = [r.asDict() for r in odd.collect()]
    assert proofs(odd) == brute(rows)
    same = [{"doc_id": 1, "text": "A", "lang": None, "source": None, "n_chars": 1}] * 20 + [
        {"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}
    ] * 3
    assert proofs(frame(spark, same)) == brute(same)
    assert proofs(frame(spark, [])) == []


def test_a_proof_fits_its_row_alone(spark):
    rows = [{"doc_id": i, "text": f"T{i}", "lang": "x", "source": "s", "n_chars": i} for i in range(70)]
    built = merkle.build(frame(spark, rows), COLUMNS, "lang", "doc_id", {"source": F.when(F.col("doc_id") != 69, "s").otherwise("t")})
    told = merkle.prove(built).collect()
    assert sorted(r["doc_id"] for r in told if not r["verified"]) == [69]
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"

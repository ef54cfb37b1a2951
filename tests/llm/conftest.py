import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text[, source]); the columns lang and n_chars are filled."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd(spark, documents):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(60_000))
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (4, "other words here"), (None, "no id"),
            (None, "no id"), (5, long), (6, long), (7, line + "\n" + line), (8, line), (9, "é ü \u3000 漢字 \u00a0x")]
    docs = documents([(i, t, None if i == 4 else "s") for i, t in rows])
    clash = ["kept", "size", "score", "n", "component_id", "line", "node", "target", "times", "key", "cell", "i", "rank"]
    return docs.withColumns({c: F.lit(None).cast("int") for c in clash})

"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

Features of a text: its words, its pairs of neighbouring words, the shapes of its words and
pairs of shapes (case, digits, symbols; a word that repeats the one before has a shape of its
own), each hashed to one of 2**BITS columns and valued by the square root of its count, scaled
to length one. Labelled rows, a bounded sample, are dealt to SHARDS groups; each group runs the
per-coordinate updates over its rows; the weights are averaged. A text's score is the logistic
function of the sparse dot product.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.llm.common import map_texts, per_worker
from municare.llm.trees import sampled_labels

BITS = 18
SAMPLE = 24_000  # labelled documents that are learned from, at most
SHARDS = 4
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.01
_KNOWN_MOST = 500_000
_SHAPE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"A" * 26 + b"a" * 26 + b"0" * 10
)


def _shape(word: bytes) -> bytes:
    """Letters as A or a (bytes beyond ASCII as a), digits as 0, runs cut to one."""
    plain = bytes(b if b < 128 else 97 for b in word.translate(_SHAPE))
    return bytes(b for i, b in enumerate(plain) if i == 0 or b != plain[i - 1])[:8]


class Features:
    """Sparse features of texts; remembers the hashes of words it has met."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(columns, values); a text without words has none."""
        words = text.split() if text else []
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        known = self.known
        if len(known) > _KNOWN_MOST:
            known.clear()
        for w in set(words).difference(known):
            known[w] = zlib.crc32(w.lower()), zlib.crc32(_shape(w), 77)
        both = np.array([known[w] for w in words], np.uint64)
        ids, shapes = both[:, 0], both[:, 1]
        shapes[1:][ids[1:] == ids[:-1]] = 7
        many, odd = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
        grams = [ids * many, (ids[:-1] * odd + ids[1:]) * many, shapes * odd, (shapes[:-1] * many + shapes[1:]) * odd]
        hashed = np.concatenate(grams)
        hashed ^= hashed >> np.uint64(32)
        columns, counts = np.unique((hashed & self.mask).astype(np.int64), return_counts=True)
        values = np.sqrt(counts)
        return columns, values / np.sqrt((values**2).sum())


def learn(examples: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over the examples, in their order. The last is the bias."""
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for columns, values, label in examples:
            at, x = np.append(columns, size), np.append(values, 1.0)
            zt, nt = z[at], n[at]
            wt = np.where(np.abs(zt) <= L1, 0.0, -(zt - np.sign(zt) * L1) / ((BETA + np.sqrt(nt)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wt @ x, -35, 35)))
            g = (p - label) * x
            z[at] += g - (np.sqrt(nt + g * g) - np.sqrt(nt)) / ALPHA * wt
            n[at] += g * g
    lead = np.abs(z) > L1
    w[lead] = -(z[lead] - np.sign(z[lead]) * L1) / ((BETA + np.sqrt(n[lead])) / ALPHA + L2)
    return w


def fit(documents: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE, chosen=None) -> np.ndarray:
    """Averaged weights of all shards, 2**BITS and the bias. Zeros without labels."""
    picked = sampled_labels(labels, label, sample, chosen)
    rows = documents.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__doc"))
    rows = rows.select("__doc", "__label", "text")

    worker = per_worker(documents.sparkSession, Features)

    def features(texts):
        make = worker()
        found = [make(t) for t in texts]
        return {
            "__columns": pa.array([c.astype(np.int32) for c, _ in found], pa.list_(pa.int32())),
            "__values": pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
        }

    rows = map_texts(rows, ["__doc", "__label"], "text", features, "__columns array<int>, __values array<float>")
    # An id that rows repeat counts once.
    rows = rows.dropDuplicates(["__doc"])
    shard = F.pmod(F.xxhash64(F.lit(6), "__doc"), F.lit(SHARDS))

    def shard_weights(group: pd.DataFrame) -> pd.DataFrame:
        order = group["__doc"].map(lambda d: zlib.crc32(str(d).encode(), 6)).argsort(kind="stable")
        group = group.iloc[order]
        examples = [
            (np.asarray(c, np.int64), np.asarray(v, float), int(y))
            for c, v, y in zip(group["__columns"], group["__values"], group["__label"])
        ]
        w = learn(examples, 1 << BITS)
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at.astype(np.int64), "w": w[at]})

    learned = rows.groupBy(shard.alias("shard")).applyInPandas(shard_weights, "at bigint, w double")
    # Bounded by the columns of the model.
    mean = learned.groupBy("at").agg((F.sum("w") / F.lit(float(SHARDS))).alias("w")).toPandas()
    weights = np.zeros((1 << BITS) + 1)
    weights[mean["at"].to_numpy(np.int64)] = mean["w"].to_numpy(float)
    return weights


def scores(documents: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score``, the probability of label 1, of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    worker = per_worker(documents.sparkSession, Features)

    def each(texts):
        make, w = worker(), shared.value
        margins = np.empty(len(texts))
        for i, text in enumerate(texts):
            columns, values = make(text)
            margins[i] = w[columns] @ values + w[-1]
        return {"score": pa.array(1.0 / (1.0 + np.exp(-np.clip(margins, -35, 35))), pa.float64())}

    return map_texts(documents, keep, "text", each, "score double")


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, score, predicted.

    Learns only from labels whose crc32 of the id as text leaves 0 or 2 when divided by 3; the
    others are held out. Null and empty texts get the score of the bias. A null id is not held
    out. Without labels every score is a half. Rows without an id or label teach nothing, of
    several labels the lowest counts; other columns are not read.
    """
    fold = F.pmod(F.crc32(F.col("__doc").cast("string").cast("binary")), F.lit(3))
    weights = fit(documents, labels, label, sample, fold != 1)
    rows = scores(documents, weights, ["doc_id"])
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    predicted = (F.col("score") >= 0.5).cast("int")
    return rows.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))

"""Quality rules: document statistics, base rules, and gradient-boosted trees on top.

Method: logistic gradient boosting on histograms of document statistics. On chosen statistics
the score may only fall as the statistic grows: a split that would break the order is refused
and the children's values are kept on their sides of the split's middle. The trees are
flattened into one numpy array per node field and a batch of documents walks all of them in
lockstep. Trees are fitted on a bounded sample of labelled documents; statistics, rules and
scores cover every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.llm.common import map_texts

SYMBOLS = b"#*$%&|<>"
SAMPLE = 20_000  # labelled documents that the trees are fitted on, at most
KEEP_FROM = 0.5  # a document is kept from this probability of good quality on
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "symbol_share", "dup_line_share", "repeat_share", "upper_share", "distinct_share",
    "mean_word", "mean_line", "short_share", "digit_share", "log_words",
)
# Statistics along which the score never rises.
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "upper_share")
_LOW = b"abcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that the text holds twice or more."""
    if len(words) < 4:
        return 0
    names = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(names) + ids[1:]
    if len(names) > 2_000_000:  # three ids would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(names) + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def statistics(text: bytes | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The five counts of a whole text and the shares that the trees see."""
    text = text or b""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    size = max(1, len(joined))
    low = len(joined) - len(joined.translate(None, _LOW))
    upper = len(joined) - len(joined.translate(None, _LOW.upper()))
    digits = len(joined) - len(joined.translate(None, _DIGITS))
    short = sum(1 for w in words if len(w) <= 2)
    many = max(1, n)
    return (n, chars, symbols, dup, repeat), (
        symbols / size,
        dup / max(1, len(lines)),
        repeat / many,
        upper / max(1, low + upper),
        len(set(words)) / many,
        chars / many,
        n / max(1, len(lines)),
        short / many,
        digits / size,
        float(np.log1p(n)),
    )


def _columns(texts) -> dict[str, pa.Array]:
    found = [statistics(t) for t in texts]
    out = {f"__{name}": pa.array([f[0][i] for f in found], pa.int64()) for i, name in enumerate(COUNTS)}
    out |= {f"__{name}": pa.array([f[1][i] for f in found], pa.float64()) for i, name in enumerate(SHARES)}
    return out


@dataclass
class Forest:
    """Flat trees: node i tests ``x[feature[i]] <= cut[i]`` and goes left or right; a leaf points
    to itself. ``roots`` holds the first node of each tree."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit_forest(
    x: np.ndarray,
    y: np.ndarray,
    directions: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 2.0,
    ridge: float = 1.0,
) -> Forest:
    """Boost ``trees`` trees on 0/1 labels. ``directions``: per column -1 falling, 1 rising, 0 free.
    ``least`` is the smallest hessian sum of a leaf."""
    columns = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(columns)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(x), base)
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots = []

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, low: float, high: float, level: int) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        here = len(nodes)
        value = float(np.clip(-g / (h + ridge), low, high))
        nodes.append([0, np.inf, here, here, rate * value])
        if level == depth:
            score[rows] += rate * value
            return here
        best = (1e-6, -1, 0)
        for j in range(columns):
            count = len(edges[j]) + 1
            if count < 2:
                continue
            gl = np.bincount(binned[rows, j], grad[rows], count).cumsum()[:-1]
            hl = np.bincount(binned[rows, j], hess[rows], count).cumsum()[:-1]
            vl = np.clip(-gl / (hl + ridge), low, high)
            vr = np.clip(-(g - gl) / (h - hl + ridge), low, high)
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            fine = (hl >= least) & (h - hl >= least) & (directions[j] * (vr - vl) >= 0)
            gain = np.where(fine, gain, 0)
            if gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
        if best[1] < 0:
            score[rows] += rate * value
            return here
        _, j, at = best
        goes_left = binned[rows, j] <= at
        bounds = [(low, high), (low, high)]
        if directions[j]:
            sides = rows[goes_left], rows[~goes_left]
            middle = sum(float(np.clip(-grad[s].sum() / (hess[s].sum() + ridge), low, high)) for s in sides) / 2
            bounds = [(low, middle), (middle, high)] if directions[j] > 0 else [(middle, high), (low, middle)]
        first = grow(rows[goes_left], grad, hess, *bounds[0], level + 1)
        second = grow(rows[~goes_left], grad, hess, *bounds[1], level + 1)
        nodes[here] = [j, edges[j][at], first, second, 0.0]
        return here

    for _ in range(trees if 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(x)), p - y, p * (1 - p), -np.inf, np.inf, 0))
    flat = np.array(nodes, float).reshape(-1, 5)
    whole = lambda i: flat[:, i].astype(np.int64)
    return Forest(base, depth, np.array(roots, np.int64), whole(0), flat[:, 1], whole(2), whole(3), flat[:, 4])


def sampled_labels(labels: DataFrame, label: str, sample: int, chosen: Column | None = None) -> DataFrame:
    """At most ``sample`` rows (__doc, __label): one per document, its lowest label, the first by
    a hash of the id. Rows without id or label are no labels."""
    rows = labels.select(F.col("doc_id").alias("__doc"), F.col(label).cast("int").alias("__label"))
    rows = rows.filter("__doc is not null and __label is not null")
    if chosen is not None:
        rows = rows.filter(chosen)
    rows = rows.groupBy("__doc").agg(F.min("__label").alias("__label"))
    return rows.orderBy(F.xxhash64("__doc"), "__doc").limit(sample)


_MEASURES = ", ".join([f"__{c} bigint" for c in COUNTS] + [f"__{c} double" for c in SHARES])


def fit_rules(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, falling: tuple[str, ...] = FALLING
) -> Forest:
    """Trees fitted on at most ``sample`` labelled documents; only their texts are measured."""
    picked = sampled_labels(labels, "quality", sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__doc"))
    rows = map_texts(rows, ["__doc", "__label"], "text", _columns, _MEASURES)
    # An id that many rows repeat is one example.
    rows = rows.groupBy("__doc").agg(
        F.min("__label").alias("y"), *[F.max(f"__{c}").alias(c) for c in SHARES]
    )
    known = rows.toPandas().sort_values("__doc")
    if not len(known):
        none = np.zeros(0, np.int64)
        return Forest(np.inf, 0, none, none, none, none, none, none)
    directions = np.array([-1 if c in falling else 0 for c in SHARES])
    return fit_forest(known[list(SHARES)].to_numpy(float), known["y"].to_numpy(float), directions)


def judge(documents: DataFrame, forest: Forest, keep: list[str], keep_from: float = KEEP_FROM) -> DataFrame:
    """``keep`` columns with the counts as __n_words and so on, __score, __base_failed and __kept:
    one pass over whole texts, without a shuffle. The trees, some tens of kilobytes, travel with
    the function."""

    def each(texts):
        found = [statistics(t) for t in texts]
        columns = {f"__{c}": pa.array([f[0][i] for f in found], pa.int64()) for i, c in enumerate(COUNTS)}
        shares = np.array([f[1] for f in found], float).reshape(len(found), len(SHARES))
        return columns | {"__score": pa.array(forest.probability(shares), pa.float64())}

    schema = ", ".join(f"__{c} bigint" for c in COUNTS) + ", __score double"
    judged = map_texts(documents, keep, "text", each, schema)
    failed = (F.col("__n_words") < 50) | (F.lit(100) * F.col("__n_repeat_words") > F.lit(50) * F.col("__n_words"))
    judged = judged.withColumn("__base_failed", failed)
    return judged.withColumn("__kept", ~F.col("__base_failed") & (F.col("__score") >= F.lit(keep_from)))


def quality_rules(documents: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, the counts, base_failed, score, kept.

    A null text has no words and fails the base rules. ``base_failed``: under 50 words, or over
    half of them in repeated windows. ``kept``: passes them and the trees give at least
    KEEP_FROM. Without usable labels, or with labels of one kind, only the base rules and
    the share of good labels (1 without labels) decide. A document with several labels counts
    by the lowest. Repeated rows are judged each; other columns are not read.
    """
    slim = documents.select("doc_id", "text")
    judged = judge(slim, fit_rules(slim, labels, **how), ["doc_id"])
    return judged.select("doc_id", *[F.col(f"__{c}").alias(c) for c in (*COUNTS, "base_failed", "score", "kept")])


def kept_documents(documents: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``documents`` that ``quality_rules`` keeps, with their columns."""
    names = documents.columns
    slim = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = {name: f"c{names.index(name)}" for name in ("doc_id", "text")}
    forest = fit_rules(slim.select(*[F.col(c).alias(n) for n, c in at.items()]), labels, **how)
    judged = judge(slim.withColumn("text", F.col(at["text"])), forest, slim.columns).filter("__kept")
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])

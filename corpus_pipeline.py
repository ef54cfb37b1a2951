"""From raw documents to token ids: rules, line runs, near duplicates, mixture, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept; each result
is written as Parquet and read again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.llm import bpe, lines, minhash, mixing, trees
from municare.llm.common import stored, table
from municare.llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees."""
    return trees.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those that lose every line with a word go."""
    done = lines.line_dedup(docs)
    left = done.filter("n_deleted = 0 or n_deleted < n_lines")
    return left.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    judged = minhash.judged(docs)
    dropped = judged.filter("not __stays").select(judged["doc_id"].alias("__doc"), "__text_key").distinct()
    # An id may repeat with another text. One plan at every size: texts and decisions meet by a sorted merge.
    same = (docs["doc_id"] == dropped["__doc"]) & (F.xxhash64(docs["text"]) == dropped["__text_key"])
    return docs.join(dropped.hint("merge"), same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document of the mixture, and of the decoded text."""
    return bpe.digests(docs, VOCABULARY, ["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

# Trees, signatures and merges by rank are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

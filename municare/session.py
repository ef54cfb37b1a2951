"""Spark session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from municare import storage

# Partition values such as '202501' must stay text, casts must fail loudly, and hot
# shuffle partitions must be split at run time.
REQUIRED_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already exists."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "municare", master: str | None = None, **settings: str) -> SparkSession:
    """Session for jobs, tests and the bench; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession, *paths: str, expansion: float = 4.0, target_bytes: int = 200 << 20
) -> int:
    """Set the number of shuffle partitions from the size of the inputs, so that one partition
    fits in an executor. ``expansion`` allows for columnar compression. AQE joins partitions
    that turn out small; it cannot cut an aggregate's partition that is too large."""
    total = sum(storage.size(spark, p) for p in paths)
    wanted = math.ceil(total * expansion / target_bytes)
    partitions = max(wanted, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def narrow_scans(spark: SparkSession, most: int = 8 << 20) -> Iterator[None]:
    """Cut files into scan tasks of at most ``most`` bytes, for jobs that sort what a scan task reads: repetitive
    rows take a hundred times their file size there. A smaller setting of the session stays."""
    before = spark.conf.get(SCAN_BYTES)
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= most:
        yield
        return
    spark.conf.set(SCAN_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(SCAN_BYTES, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` that every executor can reach.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = _checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="municare-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _checkpoint_root(spark: SparkSession) -> str | None:
    name = "spark.checkpoint.dir"
    context = spark.sparkContext
    return spark.conf.get(name, None) or context.getConf().get(name) or context.getCheckpointDir()

"""The few file system calls the jobs need, on whatever file system a path names."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = _handle(spark, path)
    return fs.exists(location)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none when it does not exist."""
    location, fs = _handle(spark, path)
    if not fs.exists(location):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(location))


def remove(spark: SparkSession, path: str) -> None:
    location, fs = _handle(spark, path)
    fs.delete(location, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    origin, fs = _handle(spark, source)
    goal, _ = _handle(spark, target)
    if not fs.rename(origin, goal):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None where there is none."""
    location, fs = _handle(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there in one step, so that a reader sees
    the old content or the new one."""
    jvm = spark.sparkContext._jvm
    beside = f"{path}-{uuid.uuid4().hex}"
    location, fs = _handle(spark, beside)
    stream = fs.create(location, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    goal, _ = _handle(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        location.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context.rename(location, goal, options)


def folder_uri(spark: SparkSession, path: str) -> str | None:
    """The encoded path of a folder, as file paths in it begin after their scheme; None for a file."""
    location, fs = _handle(spark, path)
    return f"{location.toUri().getRawPath()}/" if fs.getFileStatus(location).isDirectory() else None


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    location, fs = _handle(spark, path)
    return fs.getContentSummary(location).getLength() if fs.exists(location) else 0


def last_change(spark: SparkSession, path: str) -> float:
    """When anything below a path changed last, in seconds since 1970; now, where files come and go
    while they are listed."""
    location, fs = _handle(spark, path)
    try:
        newest = fs.getFileStatus(location).getModificationTime()
        if fs.getFileStatus(location).isDirectory():
            files = fs.listFiles(location, True)
            while files.hasNext():
                newest = max(newest, files.next().getModificationTime())
    except Py4JJavaError:
        return time.time()
    return newest / 1000


@contextmanager
def locked(spark: SparkSession, path: str, wait: float = 60.0, dead_after: float = 600.0) -> Iterator[None]:
    """Hold a lock file for the few calls that swap a pointer. Its creation fails where it exists already.

    A lock older than ``dead_after`` seconds belongs to a driver that died and is taken away; holding one
    takes well under a second.
    """
    location, fs = _handle(spark, path)
    until = time.monotonic() + wait
    while True:
        try:
            fs.create(location, False).close()
            break
        except Py4JJavaError as failed:
            if not fs.exists(location):
                if "AlreadyExists" not in str(failed.java_exception.getClass()):
                    raise
                continue
            if time.time() - last_change(spark, path) > dead_after:
                fs.delete(location, False)
            elif time.monotonic() > until:
                raise TimeoutError(f"{path} is held by another load") from None
            else:
                time.sleep(0.05)
    try:
        yield
    finally:
        fs.delete(location, False)

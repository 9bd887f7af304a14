"""The few file-system questions Spark's readers and writers do not answer.

All of them go through the Hadoop file system of the path, so that they hold
for any shared storage the cluster uses.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _open(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return [n for n in names if not n.startswith(".")]


def create(spark: SparkSession, path: str, text: str = "") -> None:
    """A new small file, with the directories above it; it is there as a whole or not at all."""
    fs, where = _open(spark, path)
    beside = where.getParent().suffix(f"/.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(beside, where):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make_dir(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.mkdirs(where)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a directory."""
    fs, where = _open(spark, path)
    return fs.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory under ``spark.checkpoint.dir``, visible to every executor.

    Only a local session may run without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallystar-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""Shared working folders and the few Hadoop file-system calls the sinks need."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and tasks share one disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tierwise-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder under the shared root."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path``, on whatever file system its scheme names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = hadoop_path(spark, source)
    _, to_path = hadoop_path(spark, target)
    if not fs.rename(from_path, to_path):
        raise OSError(f"cannot rename {source} to {target}")


def make_parents(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())


def delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Bare names of the direct children of ``path``; empty if it does not exist."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; present with its whole content, or not at all."""
    fs, target = hadoop_path(spark, path)
    _, part = hadoop_path(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot write {path}")


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file, created and closed without a rename; a reader must know a half-written one by its content."""
    fs, target = hadoop_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; whether this call did.  Of several callers one does."""
    fs, target = hadoop_path(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    return True


def modified(spark: SparkSession, path: str) -> float:
    """When the file was written, in seconds since 1970."""
    fs, target = hadoop_path(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if it does not exist."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()

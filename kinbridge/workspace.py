"""Shared working folders for written intermediate tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="kinbridge-")
    return _local_roots[app]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``new_folder`` named, through its own file system."""
    if not path.startswith(f"{shared_root(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a folder that readers see."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isFile()]
    return sorted(n for n in names if n[0] not in "._")


def bytes_below(spark: SparkSession, path: str) -> int:
    """Size of a written table."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, which reads as a table without rows under a given schema."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root; it is not created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"

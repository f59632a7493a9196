"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # fixed value of Spark


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="marketbars-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session that names none gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def ensure_checkpoint_dir(spark: SparkSession, otherwise: str | None = None) -> None:
    """Make DataFrame.checkpoint() and MLlib's own checkpoints usable.

    ``otherwise`` is the folder to take when the session names none.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    # A relative path would be a folder of its own on each machine.
    usable = otherwise if otherwise and (otherwise[0] == "/" or ":/" in otherwise) else None
    context.setCheckpointDir(configured or usable or shared_dir(spark))


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made."""
    place, system = _file_system(spark, path)
    system.delete(place, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    place, system = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place))


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside, the shuffle files of a finished write or checkpoint leave the disk at once.

    Otherwise they stay until the driver happens to collect its garbage, so those of all
    steps of a job lie there together.
    """
    return setting(spark, SHUFFLES_GO, "true")

"""Shared folder for tables that a run writes only to read them back."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: staged folders of this process that are still there, with the session that wrote them
_staged: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimgauge-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; a folder that is not there is no error."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders directly below ``path``; none if it is not there."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(str(s.getPath().toString()) for s in files.listStatus(place) if s.isDirectory())


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each write ends.

    Every write is planned anew, so that no other plan reads its shuffles. Spark would otherwise remove them only
    when the JVM happens to collect its garbage, and those of all steps and runs before would fill the disk.
    """
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once and return the written table.

    The result no longer depends on the plan behind it, and survives the loss
    of any executor. :func:`discard` removes it as soon as nothing reads it any
    more; otherwise the end of the process does.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    _staged[path] = spark
    with shuffles_removed(spark):
        frame.write.parquet(path)
    written = spark.read.schema(frame.schema).parquet(path)
    written._staged_path = path
    return written


def discard(*frames: DataFrame) -> None:
    """Remove staged tables that nothing reads any more; other frames are left alone."""
    for frame in frames:
        path = getattr(frame, "_staged_path", None)
        if path is not None and path in _staged:
            remove(_staged.pop(path), path)


@atexit.register
def _discard_the_rest() -> None:
    """What a query's lazy result may have read until now; a JVM that is gone already cannot remove it."""
    for path, spark in list(_staged.items()):
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001 - whatever a gateway that is closing raises
            return
        del _staged[path]

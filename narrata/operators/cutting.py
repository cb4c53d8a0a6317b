"""Cut lineage in iterative operators."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
_scopes: list[list[str]] = []
#: Days after which another application's tables are taken for left behind by a killed driver.
STALE_DAYS = 7


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; where none is set, a fresh temporary one in local mode and an error on a cluster."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="narrata-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, wherever the cluster's file systems have it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def children(spark: SparkSession, folder: str) -> set[str]:
    """Names in a folder; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in system.listStatus(path)} if system.exists(path) else set()


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are cut inside go at the end; what is to stay has to be written by then."""
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            remove(spark, path)


def _remove_stale(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = 1000 * (time.time() - STALE_DAYS * 86_400)
    for status in system.listStatus(path) if system.exists(path) else []:
        if status.getPath().getName().startswith("narrata-") and status.getModificationTime() < oldest:
            system.delete(status.getPath(), True)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by then
        remove(spark, folder)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files, without its lineage.

    Written as a table, not as an RDD checkpoint: the plan then knows the true size (an RDD checkpoint keeps the estimate of
    the plan behind it, which joins multiply round after round). A table goes with the ``scope`` it is cut in, or when the
    driver ends; what a killed driver leaves goes after ``STALE_DAYS`` days, when another one starts to cut.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{checkpoint_folder(spark)}/narrata-{app}"
        with contextlib.suppress(Exception):  # another driver may be at it
            _remove_stale(spark, checkpoint_folder(spark))
        atexit.register(_remove_at_exit, spark, _folders[app])
    path = f"{_folders[app]}/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

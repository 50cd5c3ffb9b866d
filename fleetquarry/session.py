"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE picks join strategies and partition counts from real sizes at run time. The
# broadcast threshold stays at a size check: a dimension that outgrows it is sort-merged,
# and hot keys in that join are split by the skew rule.
_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    app: str = "fleetquarry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the reports are planned for.

    ``master`` is left to spark-submit unless given. On a cluster leave
    ``shuffle_partitions`` unset too, or set it high (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Around a write: what it has shuffled is deleted when it ends, and not some time after the driver has next cleaned its memory.

    What is written is read back from its files, so nothing needs these shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the shared folder of ``spark.checkpoint.dir``.

    Only a local session may fall back to /tmp: on a cluster a machine-local folder
    would be lost with its machine, so there an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reaches."""
    system, place = _place(spark, path)
    return system.exists(place)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, place = _place(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a whole folder; nothing happens where there is none."""
    system, place = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Moves a folder to a name that is free; the folders above it are made."""
    system, place = _place(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(goal.getParent())
    if not system.rename(place, goal):
        raise OSError(f"{path} could not be renamed to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a mark."""
    system, place = _place(spark, path)
    system.create(place, True).close()

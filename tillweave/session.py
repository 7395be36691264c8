"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def build_session(name: str = "tillweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the clock pinned to UTC."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        # Call-site capture per column expression doubles the time to declare a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local temporary folder is only used by a local master with the setting
    left empty; a cluster without the setting is an error, because a folder on
    one machine is lost with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tillweave-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate data, below the shared folder."""
    return f"{shared_folder(spark)}/tillweave/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate data; ``clear_scratch`` removes them all."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Called when scratch data is removed, by whoever remembers frames that read it.
ON_CLEAR: list[Callable[[], None]] = []


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system that Spark reads; none is fine."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has stored.  Frames that still read it are then of no use."""
    for forget in ON_CLEAR:
        forget()
    remove_folder(spark, scratch_root(spark))


def folder_state(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Name, time and bytes of each table in a folder, to notice that one was written anew."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(
        (f.getPath().getName(), f.getModificationTime(), system.getContentSummary(f.getPath()).getLength())
        for f in system.listStatus(path)
    )

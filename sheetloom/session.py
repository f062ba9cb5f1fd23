"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "sheetloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a session
    in one process takes a temporary folder; on a cluster, whose executors would
    each write to a disk of their own, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} can reach")
        base = tempfile.mkdtemp(prefix="sheetloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def children(spark: SparkSession, path: str, marked: str | None = None) -> list[str]:
    """Names in a folder, or none if it isn't there; with ``marked`` only folders that hold a file of this name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [n for n in names if marked is None or exists(spark, f"{path}/{n}/{marked}")]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run's output."""
    return f"{shared_dir(spark).rstrip('/')}/sheetloom/{name}-{uuid.uuid4().hex}"

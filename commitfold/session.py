"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Recording a call site for every column operation is most of the time it takes
    # to assemble the validation rules.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def sized(shuffle_gb: float, partition_mb: int = 128) -> dict[str, str]:
    """Settings for a largest shuffle of `shuffle_gb`: adaptive execution merges small
    partitions, but never makes more of them than a shuffle started with."""
    wanted = max(200, round(shuffle_gb * 1024 / partition_mb))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted)}


def build(master: str | None = None, app: str = "commitfold", **settings: str) -> SparkSession:
    """A session with the recommended settings; on a cluster the master is given
    by the submit command."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it. Only the two
    modules with code in such workers need it (`sources.seq_stream`, `streaming.keyed`); on
    a cluster without that path ship the package with --py-files."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run or started inside go when it ends, each batch of a
    stream by itself, and not when the driver happens to collect its garbage. For frames that
    are run once: a second run would have to make the files again."""
    was = spark.conf.get(_DROP, None)
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_DROP)
        else:
            spark.conf.set(_DROP, was)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables.

    Under the cluster's `spark.checkpoint.dir`, which every executor can reach. A
    local temporary folder is used only where that is unset on a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="commitfold-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

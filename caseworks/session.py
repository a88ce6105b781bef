"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", name: str = "caseworks", **settings: str) -> SparkSession:
    """A single-machine session with the settings the tests and the bench share."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can read and write.

    Only a session on one machine that names none, as in tests, gets a folder of its own; on a cluster that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder and not spark.sparkContext.master.partition("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that driver and executors share")
    return folder or _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="caseworks-")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that this package wrote, in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query run in here has shuffled is removed at its end; else it stays until the driver happens to collect
    its garbage, and the shuffles of queries that run one after the other add up."""
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)

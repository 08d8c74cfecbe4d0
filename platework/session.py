"""Session settings, and the shared folder that written intermediate data goes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Shuffle files go when the query that made them ends, instead of when the driver next collects garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SPLITS = "spark.sql.files.maxPartitionBytes"


def get_session(app_name: str = "platework", master: str | None = None, **conf) -> SparkSession:
    """Build a session; sizes (memory, partitions) stay with the cluster unless passed in ``conf``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording the call site of every Column costs more than building the plans themselves.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="platework-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """What lies under the paths, which need not exist."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(place):
            total += system.getContentSummary(place).getLength()
    return total


def split_bytes(spark: SparkSession) -> int:
    """Bytes of files that one task reads at most."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


@contextmanager
def writing(spark: SparkSession, splits: int | None = None) -> Iterator[None]:
    """For a job that writes a table: its shuffles leave the disk with it, and a task reads ``splits`` bytes at most. What
    the session has set is put back."""
    settings = {_SHUFFLES_GO: "true"}
    if splits is not None and splits < split_bytes(spark):
        settings[_SPLITS] = f"{splits}b"
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

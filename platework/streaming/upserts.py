"""A table kept current from a stream of changes.

Each micro-batch is cut to the newest change per key and written to a folder named after the batch, so a
batch that is replayed replaces itself. Readers merge the batches onto the last compacted base; a batch
thus costs its own size, not the table's. Paths that are being read are never overwritten.

Of changes with the same sequence the one of the later batch wins. The base keeps the newest change of deleted
keys too, marked, so that an older change that comes in late does not bring a row back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from platework.operators.latest import dedup_latest
from platework.sources.tables import append_table

_GONE = "__gone"
_VERSIONS = T.StructType([T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class Keyed:
    """A table under ``path``: its key, what orders its changes, and which changes are deletes.

    NULL is a key like any other: rows without a key replace each other.
    """

    path: str
    keys: list[str]
    sequence_by: list[str]
    delete_when: Column | None = None

    @property
    def changes(self) -> str:
        return f"{self.path}/changes"

    @property
    def versions(self) -> str:
        return f"{self.path}/versions"

    def base(self, version: int) -> str:
        return f"{self.path}/base/version={version}"


def append_changes(batch: DataFrame, batch_id: int, table: Keyed) -> None:
    newest = dedup_latest(batch, table.keys, [F.col(c).desc_nulls_last() for c in table.sequence_by])
    newest.write.mode("overwrite").parquet(f"{table.changes}/batch={batch_id}")


def follow_changes(changes: DataFrame, table: Keyed, checkpoint: str) -> StreamingQuery:
    """Write the changes that have arrived since the checkpoint, then stop.

    A table belongs to one checkpoint, which numbers its batches: with a new checkpoint use a new path.
    """
    query = (
        changes.writeStream.foreachBatch(lambda batch, batch_id: append_changes(batch, batch_id, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def last_version(spark: SparkSession, table: Keyed) -> int | None:
    """The newest batch that a finished compaction holds."""
    try:
        versions = spark.read.schema(_VERSIONS).parquet(table.versions)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return versions.agg(F.max("version").alias("v")).first()["v"]


def _resolved(spark: SparkSession, table: Keyed) -> DataFrame:
    """The newest change of every key, with its batch and whether it deletes the key."""
    version = last_version(spark, table)
    changes = spark.read.parquet(table.changes)
    doomed = F.coalesce(table.delete_when, F.lit(False)) if table.delete_when is not None else F.lit(False)
    if version is not None:
        changes = changes.where(F.col("batch") > version)
    changes = changes.withColumns({"batch": F.col("batch").cast("long"), _GONE: doomed})
    if version is not None:
        changes = changes.unionByName(spark.read.parquet(table.base(version)))
    return dedup_latest(changes, table.keys, [F.col(c).desc_nulls_last() for c in [*table.sequence_by, "batch"]])


def current_state(spark: SparkSession, table: Keyed) -> DataFrame:
    """The table as of the last batch written."""
    return _resolved(spark, table).where(~F.col(_GONE)).drop("batch", _GONE)


def compact(spark: SparkSession, table: Keyed) -> int:
    """Write the newest changes as a new base and record it once it is whole; returns its version."""
    last = spark.read.parquet(table.changes).agg(F.max("batch").alias("b")).first()["b"]
    version = last_version(spark, table)
    if version is None or last > version:
        _resolved(spark, table).write.mode("overwrite").parquet(table.base(last))
        append_table(spark.createDataFrame([(last,)], _VERSIONS), table.versions)
    return last

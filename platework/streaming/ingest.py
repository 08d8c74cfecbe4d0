"""Load-once ingest of arriving JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from platework.sources.documents import LANDED, accept_documents, is_json, with_lineage


#: By default the source passes over files a week older than the newest it has seen; a copy may keep old times.
NO_AGE_LIMIT = "36500d"


def ingest_new(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    on_error: str = "continue",
    max_files: int | None = None,
) -> StreamingQuery:
    """Land the files the checkpoint has not seen, then stop; call it again whenever files may have come.

    "abort" fails on a bad file and leaves it to be tried again. "continue" lands it too, marked, so
    that it is on record and not read again; ``landed`` and ``landing_rejects`` tell the two apart.
    """
    reader = spark.readStream.format("text").option("wholetext", True).option("maxFileAge", NO_AGE_LIMIT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = with_lineage(reader.load(in_dir))
    if on_error == "abort":
        files = accept_documents(files, "abort")
    query = (
        files.withColumn("accepted", is_json())
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def landed(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(out_dir).where("accepted").select(*LANDED)


def landed_with_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """All that has landed, with ``accepted``."""
    return spark.read.parquet(out_dir).select(*LANDED, "accepted")


def landing_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(out_dir).where(~F.col("accepted")).select("source_file", "loaded_at")

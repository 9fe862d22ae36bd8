"""Catalog records as a stream: files of JSON lines arrive, are checked and classified, and land in one table.

classified_stream() holds no state, so late files are like any other. distinct_stream() drops records whose md5 came before within a
watermark on the times at which files were written; its state outlives restarts. Each micro-batch is written once: the file sink's
log keeps a restarted query from writing it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators import classify, contract
from quern.sources.records import RECORD


def _valid(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """RECORD's columns and written_at of the valid records."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path).select("value", F.col("_metadata.file_modification_time").alias("written_at")).where(F.trim("value") != "")
    checked = lines.select("value", "written_at", contract.blocking(contract.reasons(F.col("value"))).alias("reasons"), F.from_json("value", RECORD).alias("r"))
    return checked.where(F.size("reasons") == 0).select("r.*", "written_at")


def classified_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A streaming frame of classified records of the JSON-line files that appear under path."""
    return classify.classify(_valid(spark, path, max_files).drop("written_at"))


def distinct_stream(spark: SparkSession, path: str, within: str = "1 hour", max_files: int = 100) -> DataFrame:
    """classified_stream() without repeats: one record of each md5 and data set among files written less than `within` apart.

    A key is forgotten once the watermark (the newest file's time less `within`) has passed its own time plus `within`, so
    state is bounded by what arrives in that time; a repeat that comes in the batch that moves the watermark is dropped, too. Records that are older than the watermark are dropped.
    """
    fresh = _valid(spark, path, max_files).withWatermark("written_at", within).dropDuplicatesWithinWatermark(["file_md5sum", "dataset_id"])
    return classify.classify(fresh.drop("written_at"))


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, distinct: str | None = None, max_files: int = 100) -> StreamingQuery:
    """Classifies all files that are there and stops; called again, it takes up the new ones.

    distinct: within which time a record's repeats are dropped; None keeps them.
    """
    rows = distinct_stream(spark, path, distinct, max_files) if distinct else classified_stream(spark, path, max_files)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

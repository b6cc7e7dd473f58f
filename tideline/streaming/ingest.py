"""Incremental ingestion: each raw document once, with Spark's own checkpoints as
the record of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.sources import envelopes


def documents(spark: SparkSession, root: str) -> DataFrame:
    """A stream of the documents below ``root``, keyed by their paths."""
    files = spark.readStream.option("recursiveFileLookup", "true").option("wholetext", "true").option("pathGlobFilter", "*.json").text(root).select(F.col("_metadata.file_path").alias("file"), "value")
    return files.withColumns(envelopes.path_keys(F.col("file")))


def ingest(spark: SparkSession, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append the records of new documents to a Parquet table, one JSON text a record, and end.

    Damaged documents have a row with a null record, so they are seen and not lost.
    """
    parsed = envelopes.parsed(documents(spark, root))
    rows = parsed.select("endpoint", "year", "meeting_key", "session_key", "driver_number", "file", "readable", F.posexplode_outer("data").alias("pos", "rec"))
    out = rows.withColumn("record", F.to_json("rec")).drop("rec")
    return out.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_counts(events: DataFrame, at: str, kind: str, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Events of each kind in tumbling windows, late ones up to ``lateness`` included; for batches and streams alike."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(at, lateness)
    return timed.groupBy(F.window(at, width), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), kind, "n")

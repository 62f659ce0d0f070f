"""Photometry as a stream of files: an unbounded source with exactly-once restarts, against a fixed catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, catalog: DataFrame | None = None, files_per_batch: int = 50) -> None:
    """Append every file that is new since the last run, then stop. The checkpoint names the files that are done, so a restart neither loses nor repeats
    rows; catalog (a table built before, with star_id) keeps only its stars."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    if catalog is not None:
        rows = rows.join(catalog.select("star_id"), "star_id", "left_semi")
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def running_quality(spark: SparkSession, source: str, schema, checkpoint: str, name: str, watermark: str = "1 day") -> None:
    """Six-hour counts of good and all rows in a memory table, by event time with a watermark (column ts)."""
    rows = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    counts = rows.groupBy(F.window("ts", "6 hours")).agg(F.count("*").alias("n_total"), F.count_if(F.col("event_type") != "error").alias("n_good"))
    counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

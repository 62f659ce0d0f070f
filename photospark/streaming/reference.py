"""Photometry of a stream against a reference catalog that the stream itself fixes.

The first batch that has a good epoch of a field fixes the field's stars (those of its earliest good epoch) and its cadence. Later rows, of whatever epoch, keep
only those stars; another cadence is an error. The state is two tables beside the target, written per batch: so it is joined like any table, however many
stars there are, and a batch that runs again after a failure writes the same files again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FIELD = ["sector", "camera", "ccd"]
_FIELDS = "sector int, camera int, ccd int, reference_epoch int, cadence double"


class CadenceChanged(ValueError):
    """A field's files come at another cadence than its reference epoch."""


def _before(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """What earlier batches wrote; nothing if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema + ", batch long").parquet(path).where(F.col("batch") < batch).drop("batch")


def measure(spark: SparkSession, source: str, schema, target: str, checkpoint: str, files_per_batch: int = 50) -> None:
    """Take in every file that is new since the last run (rows: sector, camera, ccd, epoch, cadence, star_id, quality, ...), then stop. Rows of quality 0 are good.
    Fields without a good epoch yet give nothing, and their rows are not kept. Raises CadenceChanged before anything of the batch is written."""
    star = dict((f.name, f.dataType.simpleString()) for f in schema.fields)["star_id"]
    stars_schema = f"sector int, camera int, ccd int, star_id {star}"

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        fields, stars = _before(own, f"{target}/fields", _FIELDS, number), _before(own, f"{target}/catalog", stars_schema, number)
        batch = batch.persist()
        try:
            good = batch.where("quality = 0").join(fields, FIELD, "left_anti")
            first = good.groupBy(*FIELD).agg(F.min("epoch").alias("reference_epoch"))
            new = good.join(first, FIELD).where("epoch = reference_epoch")
            new_fields = new.groupBy(*FIELD, "reference_epoch").agg(F.min("cadence").alias("cadence"))
            every = fields.unionByName(new_fields)
            other = batch.join(every.select(*FIELD, F.col("cadence").alias("known")), FIELD).where("abs(cadence - known) > 1e-9 * known").select(*FIELD, "cadence", "known").limit(1).collect()
            if other:
                raise CadenceChanged(f"{other[0].asDict()}")
            new_stars = new.select(*FIELD, "star_id").distinct()
            kept = batch.join(stars.unionByName(new_stars), [*FIELD, "star_id"], "left_semi")
            kept.write.mode("overwrite").parquet(f"{target}/photometry/batch={number}")
            new_stars.write.mode("overwrite").parquet(f"{target}/catalog/batch={number}")
            new_fields.write.mode("overwrite").parquet(f"{target}/fields/batch={number}")
        finally:
            batch.unpersist()

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def photometry(spark: SparkSession, schema, target: str) -> DataFrame:
    """What was kept. A repeated row of one star, epoch and field stays once: the first by batch."""
    columns = [f.name for f in schema.fields]
    rows = spark.read.parquet(f"{target}/photometry")
    order = Window.partitionBy(*FIELD, "star_id", "epoch").orderBy("batch", *[c for c in columns if c not in (*FIELD, "star_id", "epoch")])
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*columns)

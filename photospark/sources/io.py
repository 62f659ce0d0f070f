"""Readers and sinks with one fixed schema per table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from photospark import schema as S
from photospark.functions.stats import finite


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local master (tests) gets a new local folder; a cluster, whose
    executors don't see the driver's folders, an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="photospark-"))
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later steps survive lost executors, see fixed rows, and don't run what made them again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: By application, the folder of local sessions without a setting.
_LOCAL: dict[str, str] = {}


def normalize_photometry(df: DataFrame) -> DataFrame:
    """Columns under their common names: flux_raw and flux_err to flux and flux_error, quality_flag to quality, btjd from mjd where it is missing; NaN and
    infinities as null."""
    have = set(df.columns)
    first = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have])
    renamed = {"flux": ("flux", "flux_raw"), "flux_error": ("flux_error", "flux_err"), "quality": ("quality", "quality_flag"), "btjd": ("btjd", "mjd")}
    new = {n: first(*names) for n, names in renamed.items() if have & {*names}}
    new = {n: finite(c.cast("double")) if n != "quality" else c.cast("int") for n, c in new.items()}
    return df.withColumns(new).drop("flux_raw", "flux_err", "quality_flag", "mjd")


def first_existing(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """The first path that can be read (Parquet, CSV with a header, or JSON by ending), with the given schema for CSV and JSON. Paths may be in any store that
    Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for p in paths:
        path = hadoop(p)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            r = spark.read.schema(schema) if schema and not p.endswith(".parquet") else spark.read
            return r.parquet(p) if p.endswith(".parquet") else r.csv(p, header=True) if p.endswith(".csv") else r.json(p)
    raise FileNotFoundError(", ".join(paths))


def sector_path(root: str, sector: int, camera: int, ccd: int) -> str:
    return f"{root}/sector={sector}/camera={camera}/ccd={ccd}"


def write_photometry(df: DataFrame, root: str) -> None:
    """Parquet by sector, camera and ccd, which must be columns; rows of a partition go to few files, in order of star and time for tight row groups."""
    df.repartition("sector", "camera", "ccd", F.pmod(F.xxhash64("star_id"), F.lit(16))).sortWithinPartitions("star_id", "btjd").write.mode("overwrite").partitionBy("sector", "camera", "ccd").parquet(root)


def read_photometry(spark: SparkSession, root: str, sector: int | None = None) -> DataFrame:
    """All of it, or one sector by partition pruning."""
    df = spark.read.schema(S.PHOTOMETRY + ", sector int, camera int, ccd int").parquet(root)
    return df if sector is None else df.where(F.col("sector") == sector)


def latest(spark: SparkSession, pattern: str) -> DataFrame:
    """Of JSON documents the rows of the file changed last."""
    rows = spark.read.json(pattern, multiLine=True).withColumn("changed", F.col("_metadata.file_modification_time"))
    return rows.join(F.broadcast(rows.agg(F.max("changed").alias("changed"))), "changed").drop("changed")

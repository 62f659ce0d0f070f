"""Several tables and a summary as one commit: all of them become visible by one small file, or none does.

A run writes its tables into a folder of its own, then names them in ``manifests/<number>.json``, created only if no such file is there. Readers take the
highest number. So a lost task, a failed table or a second writer leaves nothing half: what no manifest names is not seen."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from photospark.operators import quality

FORMATS = ("parquet", "csv", "json")


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; an error if there is one."""
    store, p = _store(spark, path)
    out = store.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    store, p = _store(spark, f"{root}/manifests")
    names = [s.getPath().getName() for s in store.listStatus(p)] if store.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def commit(spark: SparkSession, root: str, tables: dict[str, DataFrame | tuple[DataFrame, str]], summary: dict[str, object] | None = None) -> dict[str, object]:
    """Write ``tables`` (a DataFrame, or one with its format) and make them and the summary visible together; the manifest. Raises what a table's job
    raises, and FileExistsError if another writer was first to this number: then nothing of this run is seen."""
    root, run = root.rstrip("/"), uuid.uuid4().hex
    number = max(_numbers(spark, root), default=-1) + 1
    told = {}
    for name, table in tables.items():
        df, kind = table if isinstance(table, tuple) else (table, "parquet")
        if kind not in FORMATS:
            raise ValueError(f"{kind} is none of {', '.join(FORMATS)}")
        path = f"runs/{run}/{name}.{kind}"
        writer = df.write.option("header", True) if kind == "csv" else df.write
        writer.format(kind).save(f"{root}/{path}")
        told[name] = {"path": path, "format": kind, "schema": df.schema.jsonValue()}
    manifest = {"number": number, "run": run, "written": datetime.now(timezone.utc).isoformat(), "tables": told, "summary": summary or {}}
    try:
        _create(spark, f"{root}/manifests/{number:09d}.json", json.dumps(manifest, default=str))
    except Exception as e:
        if "AlreadyExists" in str(e):
            raise FileExistsError(f"{root}: another run was committed as number {number}") from e
        raise
    return manifest


def manifest_of(spark: SparkSession, root: str, number: int | None = None) -> dict[str, object]:
    """The manifest of the last commit, or of an earlier one. FileNotFoundError if there is none."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers or number is not None and number not in numbers:
        raise FileNotFoundError(f"{root} has no commit" + ("" if number is None else f" {number}"))
    at = f"{root}/manifests/{(numbers[-1] if number is None else number):09d}.json"
    return json.loads("\n".join(r[0] for r in spark.read.text(at, wholetext=True).collect()))


def read(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the last commit, or of an earlier one."""
    from pyspark.sql.types import StructType

    table = manifest_of(spark, root, number)["tables"][name]
    reader = spark.read.schema(StructType.fromJson(table["schema"]))
    return (reader.option("header", True) if table["format"] == "csv" else reader).format(table["format"]).load(f"{root.rstrip('/')}/{table['path']}")


def save_cleaning(spark: SparkSession, root: str, cleaned: quality.Cleaned) -> dict[str, object]:
    """epoch_qc, star_qc, the rows with masks, and the bad epochs as JSON, in one commit."""
    bad = cleaned.epochs.where("is_bad").select("epoch", "btjd", "reason").orderBy("epoch")
    total = cleaned.epochs.agg(F.count("*").alias("n_epochs"), F.count_if("is_bad").alias("n_bad_epochs")).first().asDict()
    return commit(spark, root, {"epoch_qc": cleaned.epochs, "star_qc": cleaned.stars, "photometry_with_masks": cleaned.rows, "bad_epochs": (bad, "json")}, total)


def save_run(spark: SparkSession, root: str, phot: DataFrame, catalog: DataFrame) -> dict[str, object]:
    """A run's catalog as JSON, its photometry as CSV and Parquet, and the summary, in one commit."""
    summary = quality.run_summary(phot).first().asDict()
    return commit(spark, root, {"catalog": (catalog, "json"), "photometry_csv": (phot, "csv"), "photometry": phot}, summary)


def save_sector_report(spark: SparkSession, root: str, sectors: DataFrame) -> dict[str, object]:
    """The quality table of sectors as JSON, with the counts of each level as its summary."""
    levels = {r["quality"]: r["count"] for r in sectors.groupBy("quality").count().collect()}
    return commit(spark, root, {"sectors": (sectors, "json")}, levels)

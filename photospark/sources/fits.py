"""FITS images as a Spark data source: ``spark.read.format("fits").load(folder)``.

Rows are files. Ask for columns with ``.schema(...)``: without ``pixels`` (and width, height) only headers are read, the data between them is passed over.
Files whose name carries sector, camera and CCD (-s0070-1-2-) are left out of the plan where pushed filters rule them out; the others where their header does.
Paths are those of ``pyarrow.fs`` (local folders, HDFS, S3, GCS); stores that only Spark's readers open go through ``binaryFile`` and image.fits_metadata."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from photospark.operators import aperture, wcs
from photospark.operators.image import fits_header, image_of

SCHEMA = f"filename string, valid boolean, error string, date_obs string, sector int, camera int, ccd int, btjd_mid double, mjd_obs double, exposure_time double, gain double, wcs {wcs.WCS}, width int, height int, pixels array<double>"
NUMBERS = ("sector", "camera", "ccd")
BLOCK = 2880


def named_numbers(name: str) -> dict[str, int]:
    """Sector, camera and CCD as a file's name carries them, if it does."""
    m = re.search(r"-s(\d+)-(\d+)-(\d+)-", name)
    return dict(zip(NUMBERS, map(int, m.groups()), strict=True)) if m else {}


def _open(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, at


def list_files(folder: str) -> list[str]:
    """The .fits files of a folder and those below it, or one file, by name."""
    from pyarrow import fs

    system, at = _open(folder)
    if system.get_file_info(at).is_file:
        return [at]
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.path.lower().endswith((".fits", ".fit")))


def read_units(stream, pixels: bool) -> Iterator[tuple[dict[str, object], np.ndarray | None]]:
    """(header, image) of each unit of an open file. Without ``pixels`` the data is passed over and the image is None."""
    size, at = stream.size(), 0
    while at < size:
        stream.seek(at)
        head = b""
        while True:
            block = stream.read(BLOCK)
            head += block
            try:
                cards, n = fits_header(head)
                break
            except ValueError:
                if len(block) < BLOCK or not head.startswith((b"SIMPLE  =", b"XTENSION=")):
                    if not head.strip(b" \0"):
                        return
                    raise
        length, make = image_of(cards)
        stream.seek(at + n)
        yield cards, make(stream.read(length)) if pixels and make is not None else None
        at += n + -(-length // BLOCK) * BLOCK


def file_row(name: str, stream, pixels: bool) -> dict[str, object]:
    """A file's row; one that can't be read gives valid false and its error."""
    row: dict[str, object] = {"filename": name, "valid": True} | named_numbers(name)
    try:
        merged: dict[str, object] = {}
        for cards, image in read_units(stream, pixels):
            merged = cards | merged
            if image is not None and image.ndim == 2 and "pixels" not in row:
                row |= {"height": image.shape[0], "width": image.shape[1], "pixels": [float(v) for v in image.ravel()]}
            if int(cards.get("NAXIS", 0)) == 2 and "wcs" not in row and (found := wcs.wcs_of(cards)):
                row["wcs"] = found
        start, stop, exposure = merged.get("TSTART"), merged.get("TSTOP"), merged.get("EXPOSURE")
        gains = [float(merged[f"GAIN{c}"]) for c in "ABCD" if f"GAIN{c}" in merged]
        mjd = merged.get("MJD-OBS", merged.get("MJD-BEG"))
        row |= {n: int(merged[n.upper()]) for n in NUMBERS if isinstance(merged.get(n.upper()), (int, float))}
        row |= {
            "date_obs": merged.get("DATE-OBS"), "btjd_mid": None if start is None or stop is None else (start + stop) / 2, "mjd_obs": None if mjd is None else float(mjd),
            "exposure_time": None if exposure is None else exposure * 86400, "gain": sum(gains) / len(gains) if gains else 5.2,
        }
    except (ValueError, KeyError, IndexError, TypeError, OSError) as e:
        row |= {"valid": False, "error": str(e)}
    return row


@dataclass
class Files(InputPartition):
    value: int
    paths: list[str] = field(default_factory=list)


class FitsReader(DataSourceReader):
    def __init__(self, schema, options) -> None:
        self.columns = [f.name for f in schema.fields]
        self.path, self.each = options["path"], int(options.get("filesPerPartition", "8"))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] not in NUMBERS:
                yield f
            else:
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values

    def fits(self, numbers: dict[str, object]) -> bool:
        return all(numbers.get(n) in values for n, values in self.wanted.items() if n in numbers)

    def partitions(self) -> list[Files]:
        paths = [p for p in list_files(self.path) if self.fits(named_numbers(p.rsplit("/", 1)[-1]))]
        return [Files(i, paths[i : i + self.each]) for i in range(0, len(paths), self.each)] or [Files(0)]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = _open(self.path)
        wants = bool({"pixels", "width", "height"} & {*self.columns})
        for path in partition.paths:
            with system.open_input_file(path) as stream:
                row = file_row(path.rsplit("/", 1)[-1], stream, wants)
            if all(row.get(n) in values for n, values in self.wanted.items()):
                yield tuple(tuple(row[c].values()) if c == "wcs" and row.get(c) else row.get(c) for c in self.columns)


class FitsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FitsReader:
        return FitsReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FitsSource)


def images_and_pixels(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows of the source: images (image, sector, camera, ccd, wcs, width, height, median, deviation, gain, exposure, btjd) and their pixels (image, x, y,
    value). image is the file's name; files without a picture give none."""
    ok = files.where(F.col("valid") & F.col("pixels").isNotNull())
    sound = F.filter("pixels", lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))
    ordered = F.sort_array(sound)
    n = F.size(ordered)
    mid = (F.get(ordered, ((n - 1) / 2).cast("int")) + F.get(ordered, (n / 2).cast("int"))) / 2
    mean = F.aggregate(sound, F.lit(0.0), lambda a, v: a + v) / n
    images = ok.select(F.col("filename").alias("image"), *NUMBERS, "wcs", "width", "height", mid.alias("median"), sound.alias("_v"), mean.alias("_mean"), "gain", F.col("exposure_time").alias("exposure"), F.col("btjd_mid").alias("btjd"))
    images = images.withColumn("deviation", F.sqrt(F.aggregate(F.transform("_v", lambda v: (v - F.col("_mean")) * (v - F.col("_mean"))), F.lit(0.0), lambda a, v: a + v) / F.size("_v"))).drop("_v", "_mean")
    at = ok.select(F.col("filename").alias("image"), "width", F.posexplode("pixels").alias("at", "value"))
    return images, at.select("image", (F.col("at") % F.col("width")).alias("x"), F.expr("at div width").alias("y"), "value")


def photometry_of(files: DataFrame, stars: DataFrame, width: int, height: int) -> DataFrame:
    """Fluxes of catalog stars (star_id, sector, camera, ccd, ra, dec, ref_x, ref_y) on every image of their field: by the image's WCS, or their reference place."""
    images, pixels = images_and_pixels(files)
    places = wcs.star_positions(stars, images, [*NUMBERS], width, height)
    return aperture.aperture_photometry(pixels, places, images).join(images.select("image", *NUMBERS, "btjd"), "image", "left")

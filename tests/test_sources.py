"""The FITS source, commits of several tables, and the stream's reference catalog."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from photospark.operators import coverage, quality
from photospark.sources import commit, fits, views
from photospark.streaming import reference


def card(key, value):
    return f"{key:<8}= {value!r:>20}".ljust(80) if isinstance(value, str) else f"{key:<8}= {value:>20}".ljust(80)


def fits_file(image, **cards):
    first = "".join([card("SIMPLE", True).replace("True", "   T"), card("BITPIX", 8), card("NAXIS", 0), *[card(k.replace("_", "-"), v) for k, v in cards.items() if not k.startswith(("CR", "CD"))], "END".ljust(80)]).ljust(2880)
    second = "".join([card("XTENSION", "IMAGE   "), card("BITPIX", -64), card("NAXIS", 2), card("NAXIS1", image.shape[1]), card("NAXIS2", image.shape[0]), *[card(k, v) for k, v in cards.items() if k.startswith(("CR", "CD"))], "END".ljust(80)]).ljust(2880)
    data = image.astype(">f8").tobytes()
    return first.encode() + second.encode() + data.ljust(-(-len(data) // 2880) * 2880, b"\0")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("fits")
    os.makedirs(at / "below")
    rng = np.random.default_rng(2)
    for i in range(6):
        image = rng.normal(10, 1, (30, 40))
        image[14:17, 19:22] += 100 + i
        sector, camera = 70 + i % 2, 1 + i // 3
        where = at / "below" if i == 5 else at
        (where / f"x{i:03d}-s{sector:04d}-{camera}-2-0001-s_ffic.fits").write_bytes(
            fits_file(image, SECTOR=sector, CAMERA=camera, CCD=2, TSTART=100.0 + i, TSTOP=100.5 + i, EXPOSURE=0.25, GAINA=5.0, GAINB=6.0, CRPIX1=21.0, CRPIX2=16.0, CRVAL1=50.0, CRVAL2=-10.0, CD1_1=-0.005, CD1_2=0.0, CD2_1=0.0, CD2_2=0.005)
        )
    (at / "broken-s0070-1-2-0001-s_ffic.fits").write_bytes(b"no image")
    (at / "note.txt").write_text("x")
    return str(at)


def test_reading(spark, folder):
    fits.register(spark)
    rows = {r.filename[:4]: r for r in spark.read.format("fits").load(folder).collect()}
    assert set(rows) == {*(f"x{i:03d}" for i in range(6)), "brok"}
    assert not rows["brok"].valid and rows["brok"].error and rows["brok"].sector == 70
    one = rows["x003"]
    assert (one.sector, one.camera, one.ccd, one.btjd_mid, one.exposure_time, one.gain, one.width, one.height, len(one.pixels)) == (71, 2, 2, 103.25, 21600.0, 5.5, 40, 30, 1200)
    assert one.wcs.crval1 == 50.0 and len(one.wcs.a) == 12 and one.pixels[15 * 40 + 20] > 90


def test_headers_only_and_pushed_filters(spark, folder, monkeypatch):
    fits.register(spark)
    heads = spark.read.format("fits").schema("filename string, sector int, camera int, btjd_mid double").load(folder)
    assert heads.where("sector = 71 and camera = 2").count() == 2 and heads.where("sector in (70, 71) and camera = 1").count() == 4
    assert heads.where("btjd_mid > 103").count() == 3
    read = []

    class Spy:
        def __init__(self, path):
            self.f = open(path, "rb")

        def size(self):
            return os.fstat(self.f.fileno()).st_size

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            read.append(n)
            return self.f.read(n)

    path = next(p for p in fits.list_files(folder) if "x000" in p)
    row = fits.file_row("x", Spy(path), False)
    assert row["valid"] and row["sector"] == 70 and "pixels" not in row and sum(read) == 2 * 2880
    reader = fits.FitsReader(spark.createDataFrame([], "filename string, sector int").schema, {"path": folder, "filesPerPartition": "2"})
    left = [*reader.pushFilters([fits.EqualTo(("sector",), 70), fits.In(("camera",), (1,)), fits.EqualTo(("filename",), "x")])]
    assert len(left) == 1 and [len(p.paths) for p in reader.partitions()] == [2, 1]


def test_from_image_to_fluxes(spark, folder):
    fits.register(spark)
    stars = spark.createDataFrame([(1, s, c, 2, 50.0, -10.0, 3.0, 3.0) for s in (70, 71) for c in (1, 2)] + [(2, 70, 1, 2, None, None, 5.0, 6.0)], "star_id int, sector int, camera int, ccd int, ra double, dec double, ref_x double, ref_y double")
    got = fits.photometry_of(spark.read.format("fits").load(folder), stars, 40, 30).collect()
    bright = sorted((r.btjd, r.flux) for r in got if r.star_id == 1)
    assert len(bright) == 6 and len([r for r in got if r.star_id == 2]) == 2
    assert all(abs(flux * 21600 - 9 * (100 + i)) < 40 for i, (_, flux) in enumerate(bright))
    assert all(abs(r.x - 20) < 1e-6 and abs(r.y - 15) < 1e-6 for r in got if r.star_id == 1)
    assert coverage.calibration_order(spark.read.format("fits").schema("filename string, valid boolean, error string, mjd_obs double").load(folder)).where("epoch is not null").count() == 0  # no MJD cards


def test_commit(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        commit.manifest_of(spark, root)
    a = spark.range(10).withColumn("s", F.lit("é,\""))
    commit.commit(spark, root, {"a": a, "b": (a.limit(3), "csv"), "c": (a, "json")}, {"n": 10})
    assert [commit.read(spark, root, n).count() for n in "abc"] == [10, 3, 10] and commit.read(spark, root, "b").first().s == "é,\""
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        commit.commit(spark, root, {"a": a.limit(1), "b": broken})
    assert commit.read(spark, root, "a").count() == 10 and commit.manifest_of(spark, root)["summary"] == {"n": 10}  # nothing half
    commit.commit(spark, root, {"a": a.limit(2)})
    assert commit.read(spark, root, "a").count() == 2 and commit.read(spark, root, "a", 0).count() == 10
    with pytest.raises(ValueError):
        commit.commit(spark, root, {"a": (a, "xml")})


def test_second_writer_is_told(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    commit.commit(spark, root, {"a": spark.range(1)})
    monkeypatch.setattr(commit, "_numbers", lambda *_: [])  # as it was before the other writer's commit
    with pytest.raises(FileExistsError):
        commit.commit(spark, root, {"a": spark.range(5)})
    monkeypatch.undo()
    assert commit.read(spark, root, "a").count() == 1


def test_sinks(spark, sf, tmp_path):
    root = f"file://{tmp_path}"
    t = quality.clean_tables(views.phot_survey(spark, sf), 70, views.star_catalog(spark, sf))
    told = commit.save_cleaning(spark, f"{root}/clean", t)
    assert told["summary"]["n_epochs"] == 200 and commit.read(spark, f"{root}/clean", "bad_epochs").count() == told["summary"]["n_bad_epochs"] > 0
    assert commit.read(spark, f"{root}/clean", "photometry_with_masks").count() == 10_000
    phot = views.phot_events(spark, sf)
    assert commit.save_run(spark, f"{root}/run", phot, views.sky(spark, sf))["summary"]["n_measurements"] == 10_000
    assert commit.read(spark, f"{root}/run", "photometry_csv").agg(F.sum("flux")).first()[0] == pytest.approx(phot.agg(F.sum("flux")).first()[0])
    days = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02")], "sector int, date string").withColumn("date", F.col("date").cast("date"))
    assert json.dumps(commit.save_sector_report(spark, f"{root}/sectors", coverage.sector_quality(days))["summary"]) == '{"bad": 1}'


ROWS = "sector int, camera int, ccd int, epoch int, cadence double, star_id int, quality int, flux double"


def test_stream_fixes_its_catalog(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("source", "target", "state"))
    schema = spark.createDataFrame([], ROWS).schema

    def add(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        reference.measure(spark, source, schema, target, state)
        return sorted((r.sector, r.epoch, r.star_id) for r in reference.photometry(spark, schema, target).collect())

    add((70, 1, 1, 4, 0.1, 1, 1, 1.0), (70, 1, 1, 5, 0.1, 1, 0, 1.0), (70, 1, 1, 5, 0.1, 2, 0, 1.0), (70, 1, 1, 6, 0.1, 3, 0, 1.0))
    assert run() == [(70, 4, 1), (70, 5, 1), (70, 5, 2)]  # epoch 5 is the first good one; star 3 isn't in it
    add((70, 1, 1, 3, 0.1, 2, 0, 1.0), (70, 1, 1, 3, 0.1, 9, 0, 1.0), (71, 1, 1, 1, 0.2, 7, 1, 1.0))  # out of order, and a field without a good epoch
    again = run()
    assert again == [(70, 3, 2), (70, 4, 1), (70, 5, 1), (70, 5, 2)]
    assert run() == again  # a restart without new files
    add((71, 1, 1, 2, 0.2, 8, 0, 1.0), (70, 1, 1, 5, 0.1, 1, 0, 1.0))  # a field's first good epoch comes late; a row that repeats
    assert run() == again + [(71, 2, 8)]
    add((70, 1, 1, 8, 0.3, 1, 0, 1.0))
    with pytest.raises(Exception, match="CadenceChanged|cadence"):
        run()
    assert sorted((r.sector, r.epoch, r.star_id) for r in reference.photometry(spark, schema, target).collect()) == again + [(71, 2, 8)]


def test_clean_and_combine_commands(spark, sf, tmp_path):
    from photospark import cli

    phot, a, b = (str(tmp_path / n) for n in ("phot", "a", "b"))
    views.phot_survey(spark, sf).where("star_id < 5").write.parquet(phot)
    views.sky(spark, sf).write.parquet(a)
    views.sky(spark, sf, True).write.parquet(b)
    cli.main(["clean", phot, str(tmp_path / "clean"), "--sector", "70", "--preset", "minimal"])
    assert 0 < spark.read.parquet(str(tmp_path / "clean")).count() < 1000
    cli.main(["combine", a, b, str(tmp_path / "both")])
    assert spark.read.parquet(str(tmp_path / "both")).select("sector").distinct().count() == 2

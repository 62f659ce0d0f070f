"""python -m photospark.cli clean|stats|find-variables|combine|export IN OUT ...: photometry tables in, Parquet out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from photospark.operators import crossmatch, features, lightcurve, period, quality, score
from photospark.sources.io import normalize_photometry


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("command", choices=["clean", "stats", "find-variables", "combine", "export"])
    p.add_argument("source", nargs="+", help="Parquet tables of photometry (combine: catalogs, lowest sector first)")
    p.add_argument("target")
    p.add_argument("--sector", type=int, default=0)
    p.add_argument("--preset", default="balanced")
    p.add_argument("--min-amplitude", type=float, default=0.01)
    p.add_argument("--min-chi2", type=float, default=2.0)
    p.add_argument("--top", type=int)
    p.add_argument("--length", type=int, default=200)
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "combine":
        out = crossmatch.crossmatch_sectors({i: spark.read.parquet(s) for i, s in enumerate(a.source)})
    else:
        phot = normalize_photometry(spark.read.parquet(a.source[0]))
        phot = phot if "row" in phot.columns else phot.withColumn("row", F.col("epoch").cast("long"))
        if a.command == "clean":
            out = quality.preset(quality.clean(phot, a.sector), a.preset)
        elif a.command == "export":
            out = lightcurve.padded_sequences(phot, a.length)
        else:
            out = features.star_stats(phot)
            if a.command == "find-variables":
                periods = period.periodic_features(phot).select("star_id", F.col("power_ratio_top").alias("power_ratio"))
                out = score.variable_candidates(score.variability_scores(out.join(periods, "star_id", "left")), a.min_amplitude, chi2=a.min_chi2, top=a.top)
    out.write.mode("overwrite").parquet(a.target)


if __name__ == "__main__":
    main()

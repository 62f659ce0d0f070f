"""What the operators share: staged tables, batches of texts, and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from photospark.sources.io import shared_dir


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later steps survive lost executors and see fixed rows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as Spark's expressions take it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns, whatever their names, as one struct."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns])


def portions(texts: list[str | None], chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of consecutive texts of about ``chars`` characters (a longer text stands alone), with the place of the first; null is empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > chars:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield first, held


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Components of the graph with undirected edges ``(a, b)`` of long ids: one row ``(id, component)`` for each id with an edge, component
    being its smallest id. Rows with a null end and loops say nothing.

    Alternating large-star and small-star steps over an edge table in the shared folder: each step is a minimum per id (combined
    before the shuffle) and an equi-join that Spark can split where one id has many edges. No neighbourhood is gathered anywhere."""
    now, sums = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), None
    for _ in range(max_rounds):
        # Large star: every larger neighbour of an id is tied to the smallest of the id's neighbourhood.
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: the smaller neighbours of an id, and the id, are tied to the smallest of them. In these rows a > b.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        seen = Observation()
        now = stage(small.select("e.*").where("a <> b").distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), name)
        found = (seen.get["n"], seen.get["h"])
        if found == sums:
            break
        sums = found
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    ends = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

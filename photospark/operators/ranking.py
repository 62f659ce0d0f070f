"""Places and percentiles of any number of rows: no group in one task or one buffer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite, pct
from photospark.sources.io import stage


def numbered(df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "place") -> DataFrame:
    """``df`` with the place of each row, from 0, in the ``order`` of its group ``by`` (all rows, if none), nulls first; rows that tie are numbered in some
    order that then stays.

    Rows are dealt by ranges of group and order to the session's shuffle partitions, sorted there and written; each part counts its rows of each group, the sums
    of the parts before give every part's first place. So a group of any size is many parts, and what is gathered is a row per part and group."""
    by = by or []
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order).withColumn("_at", F.monotonically_increasing_id())
    dealt = stage(dealt, "numbered").withColumn("_part", F.shiftright("_at", 33))
    heads = dealt.groupBy("_part", *by).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_first", "_before", *[F.col(c).alias(f"_by_{c}") for c in by])
    joined = dealt.join(heads.withColumnRenamed("_part", "_head"), [dealt["_part"] == F.col("_head"), *[dealt[c].eqNullSafe(F.col(f"_by_{c}")) for c in by]])
    return joined.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))


def percentiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[Column, float]], most: int = 100_000, bins: int = 4096) -> DataFrame:
    """A row per group with the linearly interpolated percentile of each wanted (value, share); null, NaN and infinite values don't count, and a group
    without any has null.

    Exact, by counts: the range of a group's values is cut into ``bins``, equal in width and in turn equal in logarithm; the bin that holds the wanted rank
    becomes the range, until it has ``most`` values or fewer, or one value only. Passes send counts per bin, summed before the shuffle; only the last sends values,
    ``most`` a group at the most. So a group of any size is counted by all tasks."""
    groups = df.select(*by).distinct() if by else None
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(n).alias("_name"), finite(c.cast("double")).alias("_v")) for n, (c, _) in wanted.items()]))).where("_v is not null")
    share = F.element_at(F.create_map(*[F.lit(x) for n, (_, p) in wanted.items() for x in (n, float(p))]), F.col("_name"))
    keys = [*by, "_name", "_target"]
    ends = long.groupBy(*by, "_name").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    ends = ends.withColumn("_rank", (F.col("_n") - 1) * share)
    # Target 0 is the value at the rank's whole part, 1 the next one.
    ranges = ends.withColumn("_target", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_r", F.when(F.col("_target") == 0, F.floor("_rank")).otherwise(F.ceil("_rank")).cast("long"))
    ranges = stage(ranges.withColumn("_below", F.lit(0).cast("long")).withColumn("_part", (F.col("_rank") - F.floor("_rank"))).drop("_rank"), "ranges")

    def inside(of: DataFrame) -> DataFrame:
        there = of.select(*[F.col(c).alias(f"k_{c}") for c in [*by, "_name"]], "_target", "_lo", "_hi", "_r", "_below")
        same = [long[c].eqNullSafe(F.col(f"k_{c}")) if c != "_name" else long[c] == F.col(f"k_{c}") for c in [*by, "_name"]]
        return long.join(there, same).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"k_{c}" for c in [*by, "_name"]])

    turn = 0
    while not (wide := ranges.where((F.col("_n") > most) & (F.col("_lo") < F.col("_hi")))).isEmpty():
        bent = lambda c: F.signum(c) * F.log1p(F.abs(c)) if turn % 2 else F.col(c) / 2
        step = F.try_divide(bent("_v") - bent("_lo"), bent("_hi") - bent("_lo"))
        # Where the logarithms are equal, so are the bins' halves by width: the range still shrinks.
        bin_ = F.when(F.col("_v") == F.col("_hi"), bins - 1).when(F.col("_v") == F.col("_lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor(F.coalesce(step, F.lit(0.5)) * bins)))
        counts = inside(wide).groupBy(*keys, "_r", "_below", bin_.alias("_bin")).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin")) + F.col("_below")
        found = counts.withColumn("_upto", upto).where((F.col("_upto") - F.col("_n") <= F.col("_r")) & (F.col("_r") < F.col("_upto"))).withColumn("_below", F.col("_upto") - F.col("_n"))
        parts = ranges.select(*[F.col(c).alias(f"k_{c}") for c in keys], "_part")
        found = found.join(parts, [found[c].eqNullSafe(F.col(f"k_{c}")) for c in keys])
        done = ranges.where((F.col("_n") <= most) | (F.col("_lo") >= F.col("_hi")))
        ranges = stage(done.unionByName(found.select(*done.columns)), "ranges")
        turn += 1
    few = inside(ranges.where("_lo < _hi")).groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_all"), F.max("_r").alias("_r"), F.max("_below").alias("_below"))
    few = few.select(*[F.col(c).alias(f"k_{c}") for c in keys], F.get("_all", (F.col("_r") - F.col("_below")).cast("int")).alias("_value"))
    values = ranges.join(few, [ranges[c].eqNullSafe(F.col(f"k_{c}")) for c in keys], "left").withColumn("_value", F.coalesce("_value", "_lo"))
    pick = lambda n, t, c: F.max(F.when((F.col("_name") == n) & (F.col("_target") == t), F.col(c)))
    out = values.groupBy(*by).agg(*[((1 - pick(n, 0, "_part")) * pick(n, 0, "_value") + pick(n, 0, "_part") * pick(n, 1, "_value")).alias(n) for n in wanted])
    if groups is None:
        return out
    named = groups.select(*[F.col(c).alias(f"k_{c}") for c in by])
    return named.join(out, [F.col(f"k_{c}").eqNullSafe(out[c]) for c in by], "left").select(*[F.col(f"k_{c}").alias(c) for c in by], *wanted)


def medians(df: DataFrame, by: list[str], values: dict[str, Column], large: bool) -> DataFrame:
    """Exact medians of groups: in buffers, or by counts where groups are ``large``. Both give the same rows."""
    if large:
        return percentiles(df, by, {n: (c, 0.5) for n, c in values.items()})
    return df.groupBy(*by).agg(*[pct(finite(c.cast("double")), 0.5).alias(n) for n, c in values.items()])


def any_group_over(df: DataFrame, by: list[str], most_rows: int) -> bool:
    """Whether a group has more than ``most_rows`` rows."""
    return not df.groupBy(*by).count().where(F.col("count") > most_rows).isEmpty()

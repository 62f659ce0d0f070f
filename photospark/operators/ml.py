"""Outlier and cluster operators over a feature table (star_id and double columns)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite, pct, ratio
from photospark.operators.knn import neighbours
from photospark.sources.io import stage


def impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing, NaN and infinite values become the column's exact median."""
    df = df.withColumns({c: finite(c) for c in columns})
    mid = df.agg(*[F.median(c).alias(f"{c}_mid") for c in columns])
    return df.crossJoin(F.broadcast(mid)).withColumns({c: F.coalesce(c, f"{c}_mid") for c in columns}).drop(*[f"{c}_mid" for c in columns])


def scale(df: DataFrame, columns: list[str], robust: bool = True) -> DataFrame:
    """(x - median) / IQR, or (x - mean) / population deviation; 0 spread leaves the difference."""
    ends = df.agg(*[(F.median(c) if robust else F.avg(c)).alias(f"{c}_at") for c in columns], *[((pct(c, 0.75) - pct(c, 0.25)) if robust else F.stddev_pop(c)).alias(f"{c}_by") for c in columns])
    by = lambda c: F.when(F.col(f"{c}_by") == 0, 1.0).otherwise(F.col(f"{c}_by"))
    return df.crossJoin(F.broadcast(ends)).withColumns({c: (F.col(c) - F.col(f"{c}_at")) / by(c) for c in columns}).drop(*[f"{c}_{x}" for c in columns for x in ("at", "by")])


def correlated_pairs(df: DataFrame, columns: list[str], least: float = 0.8) -> DataFrame:
    """Pairs of columns with |r| above ``least``, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"), "r").where(F.abs("r") > least)


def mahalanobis(df: DataFrame, columns: list[str], ridge: float = 1e-6, percentile: float = 0.95) -> DataFrame:
    """distance from the mean under the sample covariance (plus ridge), and is_outlier above its percentile. The driver inverts one small matrix."""
    k = len(columns)
    row = df.agg(*[F.avg(c) for c in columns], *[F.covar_samp(a, b) for a in columns for b in columns]).first()
    mean, inverse = np.array(row[:k], float), np.linalg.inv(np.array(row[k:], float).reshape(k, k) + ridge * np.eye(k))
    d = [F.col(c) - float(m) for c, m in zip(columns, mean, strict=True)]
    square: Column = sum((d[i] * d[j] * float(inverse[i, j]) for i in range(k) for j in range(k)), F.lit(0.0))
    out = df.withColumn("distance", F.sqrt(F.greatest(square, F.lit(0.0))))
    limit = out.agg(pct("distance", percentile).alias("limit"))
    return out.crossJoin(F.broadcast(limit)).withColumn("is_outlier", F.col("distance") > F.col("limit")).drop("limit")


def local_outlier_factor(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """(star_id, lof): mean over the k neighbours of their reachability density over the own one."""
    n = stage(neighbours(df, columns, k), "neighbours")
    reach = n.where(F.col("rank") == k).select(F.col("star_id").alias("other"), F.col("distance").alias("k_distance"))
    density = n.join(reach, "other").groupBy("star_id").agg(ratio(F.lit(1.0), F.avg(F.greatest("distance", "k_distance")) + 1e-10).alias("lrd"))
    both = n.join(density.withColumnsRenamed({"star_id": "other", "lrd": "other_lrd"}), "other").join(density, "star_id")
    return both.groupBy("star_id").agg((F.avg("other_lrd") / F.max("lrd")).alias("lof"))


def reach_of(df: DataFrame, columns: list[str], k: int = 5, share: float = 0.9) -> float:
    """The ``share`` percentile of the rows' distance to their k-th neighbour, counting themselves: a radius for ``dbscan``."""
    far = neighbours(df, columns, k - 1).where(F.col("rank") == k - 1)
    return far.agg(pct("distance", share)).first()[0]


def _components(edges: DataFrame) -> DataFrame:
    """(id, component) of each id with an edge: the smallest id that edges (a, b) lead to. Alternating large-star and small-star steps over a staged table, whose
    rounds grow with the logarithm of the longest way. No table of ids is broadcast, so nothing that grows with them comes to the driver."""
    now, seen = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"), None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low.hint("merge"), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stage(small.select("e.*").where("a <> b").distinct(), "edges")
        found = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if found == seen:
            break
        seen = found
    ends = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def dbscan(df: DataFrame, columns: list[str], eps: float, least: int = 5) -> DataFrame:
    """(star_id, cluster): the smallest core id of the cluster, null for noise. Links within ``eps`` come from cells of that width in the first two columns;
    a point counts itself; border points go to the smallest core cluster. Rows with equal values are one point of their number's weight. Cores of a cell so small
    that all are within ``eps`` are one node, and clusters are the components of the nodes."""
    at = lambda c, k=0: (F.floor(F.col(c) / F.lit(eps)) + k).cast("long")
    two = columns[:2]
    rows = df.select("star_id", *[finite(F.col(c).cast("double")).alias(c) for c in columns])
    points = stage(rows.dropna(subset=columns).groupBy(*columns).agg(F.min("star_id").alias("id"), F.count("*").alias("w")), "points")
    right = points.select(F.col("id").alias("b"), "w", *[F.col(c).alias(f"o_{c}") for c in columns], *[at(c).alias(f"cell_{c}") for c in two])
    left = points.select(F.col("id").alias("a"), *columns)
    for c in two:
        left = left.withColumn(f"cell_{c}", F.explode(F.array(*[at(c, k) for k in (-1, 0, 1)])))
    d2 = sum(((F.col(c) - F.col(f"o_{c}")) * (F.col(c) - F.col(f"o_{c}")) for c in columns), F.lit(0.0))
    links = stage(left.join(right.hint("merge"), [f"cell_{c}" for c in two]).where(F.sqrt(d2) <= eps).select("a", "b", "w"), "links")
    core = links.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("n")).where(F.col("n") >= least).select("id")
    # A little less than the widest cell whose corners are within eps, for rounding.
    inner = eps / len(columns) ** 0.5 * (1 - 1e-6)
    cells = core.join(points.hint("merge"), "id").select("id", *[(F.floor(F.col(c) / F.lit(inner)) if eps > 0 else F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = stage(cells, "cells")
    named = cells.groupBy(*[f"c{i}" for i in range(len(columns))]).agg(F.min("id").alias("node"))
    nodes = stage(cells.join(named.hint("merge"), [f"c{i}" for i in range(len(columns))]).select("id", "node"), "nodes")
    end = lambda c: nodes.select(F.col("id").alias(c), F.col("node").alias(f"node_{c}")).hint("merge")
    edges = links.where("a < b").join(end("a"), "a").join(end("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    found = _components(edges).withColumnRenamed("id", "node")
    label = nodes.join(found.hint("merge"), "node", "left").select(F.col("id").alias("b"), F.coalesce("component", "node").alias("label"))
    cluster = links.join(label.hint("merge"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("cluster"))
    of_point = points.join(cluster.hint("merge"), "id").select(*columns, "cluster")
    return rows.join(of_point.hint("merge"), columns, "left").select("star_id", "cluster")


TREE = "tree int, feature array<int>, at array<double>, left array<int>, right array<int>, length array<double>"


def _usual(n: int) -> float:
    """Mean length of the ways in a random tree of n rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _grow(pdf: pd.DataFrame, columns: list[str], seed: int) -> pd.DataFrame:
    """One tree as arrays over its nodes: column (-1 at a leaf), split, children, and the length that a way ending there counts."""
    tree = int(pdf.tree.iloc[0])
    x = pdf.sort_values(["h", "star_id", *columns])[columns].to_numpy(float)
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []

    def add(rows: np.ndarray, depth: int, deepest: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _usual(len(rows))])
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        wide = np.flatnonzero(hi > lo)
        if len(rows) > 1 and depth < deepest and wide.size:
            c = int(rng.choice(wide))
            at = float(rng.uniform(lo[c], hi[c]))
            less = x[rows, c] <= at
            nodes[me][:4] = [c, at, add(rows[less], depth + 1, deepest), add(rows[~less], depth + 1, deepest)]
        return me

    add(np.arange(len(x)), 0, int(np.ceil(np.log2(max(2, len(x))))))
    return pd.DataFrame([[tree, *map(list, zip(*nodes, strict=True))]], columns=[c.split()[0] for c in TREE.split(", ")])


def isolation_scores(df: DataFrame, columns: list[str], trees: int = 200, sample: int = 256, seed: int = 42, contamination: float = 0.05) -> DataFrame:
    """(star_id, score, is_outlier): isolation forest; each tree has its own ``sample`` rows, drawn by hash over the whole table, and grows in a task; every
    row is scored and the top share flagged. To the driver come ``trees`` trees of fewer than 2 * sample nodes."""
    spark = df.sparkSession
    rows = df.select("star_id", *[F.col(c).cast("double") for c in columns])
    n = rows.count()
    size = min(sample, n)
    # A row offers itself to a tree if its hash is low: a few more rows than needed, so that no tree's rows are ranked over the whole table.
    share = min(1.0, (sample + 8 * sample**0.5) / max(1, n))
    limit = min(2**63 - 1, int(share * 2**64) - 2**63)
    mark = lambda tree: F.xxhash64(F.lit(seed), tree, F.col("star_id"))
    offered = rows.select(F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: mark(t) <= F.lit(limit))).alias("tree"), "star_id", *columns)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("h", "star_id", *columns))
    drawn = offered.withColumn("h", mark(F.col("tree"))).withColumn("rank", rank).where(F.col("rank") <= sample).drop("rank")
    grown = drawn.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, columns, seed), TREE).orderBy("tree").collect()
    forest = spark.sparkContext.broadcast([[np.array(v) for v in t[1:]] for t in grown])

    def score(batches):
        for pdf in batches:
            x, total, each = pdf[columns].to_numpy(float), np.zeros(len(pdf)), np.arange(len(pdf))
            for feature, at, left, right, length in forest.value:
                node = np.zeros(len(pdf), int)
                while (inner := feature[node] >= 0).any():
                    less = x[each, feature[node]] <= at[node]
                    node = np.where(inner, np.where(less, left[node], right[node]), node)
                total += length[node]
            yield pd.DataFrame({"star_id": pdf.star_id, "score": 2.0 ** (-total / max(1, len(forest.value)) / max(_usual(size), 1e-9))})

    scored = rows.mapInPandas(score, "star_id long, score double")
    return scored.crossJoin(F.broadcast(scored.agg(pct("score", 1 - contamination).alias("limit")))).withColumn("is_outlier", F.col("score") > F.col("limit")).drop("limit")


def votes(flags: DataFrame, columns: list[str], strong: int = 2) -> DataFrame:
    total: Column = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in columns), F.lit(0))
    return flags.withColumn("votes", total).withColumn("is_strong", F.col("votes") >= strong)


def combined_rank(scores: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """Sum of the scores over their sample deviations; the ``top`` largest."""
    spread = scores.agg(*[F.stddev_samp(c).alias(f"{c}_sd") for c in columns])
    total: Column = sum((F.coalesce(ratio(c, f"{c}_sd"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return scores.crossJoin(F.broadcast(spread)).withColumn("combined", total).select("star_id", "combined").orderBy(F.desc(F.round("combined", 9)), "star_id").limit(top)


def cluster_centres(df: DataFrame, columns: list[str], key: str = "cluster") -> DataFrame:
    """(cluster, n, and the mean of each column) of labelled rows; null labels are noise and count as a cluster of their own."""
    return df.groupBy(key).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])


def vote_counts(votes: DataFrame) -> DataFrame:
    """Rows by number of votes."""
    return votes.groupBy("votes").agg(F.count("*").alias("n"))


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=columns, outputCol="v").transform(df)


def kmeans(df: DataFrame, columns: list[str], ks: range = range(2, 11), least: int = 5, seed: int = 42) -> DataFrame:
    """(star_id, cluster) by the K of the best silhouette, at least ``least``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    v = stage(_vectors(df, columns), "vectors")
    model = lambda k: KMeans(k=k, seed=seed, featuresCol="v", predictionCol="cluster").fit(v)
    judge = ClusteringEvaluator(featuresCol="v", predictionCol="cluster")
    best = max(ks, key=lambda k: judge.evaluate(model(k).transform(v)))
    chosen = model(max(best, least))
    return chosen.transform(v).select("star_id", "cluster")


def principal_components(df: DataFrame, columns: list[str], k: int = 2) -> DataFrame:
    """(star_id, pc1, ...): the distributable stand-in for neighbour embeddings."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    v = _vectors(df, columns)
    out = PCA(k=k, inputCol="v", outputCol="pc").fit(v).transform(v).select("star_id", vector_to_array("pc").alias("pc"))
    return out.select("star_id", *[F.col("pc")[i].alias(f"pc{i + 1}") for i in range(k)])


def split(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the star: the same star always falls on the same side."""
    mark = F.pmod(F.xxhash64(F.lit(seed), "star_id"), F.lit(10_000)) < int(share * 10_000)
    return df.where(mark), df.where(~mark)

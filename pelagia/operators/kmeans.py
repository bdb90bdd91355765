"""k-means, its cost curve and the squared-Euclidean silhouette, on Spark ML.

Rows with equal features are first combined into one weighted row, which leaves the objective unchanged:
five 0/1 flags give at most 32 rows to iterate over, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, functions as F

from pelagia.operators.features import assemble_features
from pelagia.operators.silhouette import silhouette_euclidean
from pelagia.operators.sweep import sweep_centres, sweep_costs, sweep_labels
from pelagia.runtime import stage


# Rows with more features than this rarely repeat; they are kept as they are, with weight 1.
COMBINE_FEATURES = 16


def weighted_points(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct feature rows with their number of rows ``n``; rows with a null feature are dropped."""
    typed = df.selectExpr(*[f"cast(`{c}` AS double) AS `{c}`" for c in cols]).na.drop()
    if len(cols) > COMBINE_FEATURES:
        return stage(typed.withColumn("n", F.lit(1.0)), "points")
    return stage(typed.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("n")), "points")


def _fit(features: DataFrame, k: int, seed: int):
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", weightCol="n").fit(features)


def _relabel(model, df: DataFrame) -> DataFrame:
    """Number the clusters by the order of their centres, so equal centres always get equal numbers."""
    centres = [tuple(c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    rank = F.array(*[F.lit(order.index(i)) for i in range(len(centres))])
    return df.withColumn("cluster", F.get(rank, F.col("cluster")))


def kmeans(df: DataFrame, cols: list[str], k: int = 4, seed: int = 1) -> DataFrame:
    """Rows without null features, with their ``cluster`` (numbered by centre)."""
    features = assemble_features(weighted_points(df, cols), cols).cache()
    model = _fit(features, k, seed)
    features.unpersist()
    return _relabel(model, model.transform(assemble_features(df, cols))).drop("features")


def kmeans_cost_curve(df: DataFrame, cols: list[str], ks: list[int], seed: int = 1) -> DataFrame:
    """One row per k: the within-cluster sum of squares and the number of clusters found.

    All k are advanced together; without any rows every cost is 0 and there are no clusters.
    """
    points = weighted_points(df, cols)
    centres = sweep_centres(points, cols, ks, seed)
    costs = sweep_costs(points, cols, centres)
    return df.sparkSession.createDataFrame([(k, costs[k], len(centres[k])) for k in ks], "k int, cost double, clusters int")


def silhouette_squared(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distances, one row. Not comparable with the Euclidean one."""
    # equal rows stay apart: a weight would leave all of them out of a row's own distances, not just the row
    points = stage(df.select(*[F.col(c).cast("double").alias(c) for c in cols], cluster).na.drop(), "points")
    if points.select(cluster).distinct().limit(2).count() < 2:
        score = None
    else:
        score = float(ClusteringEvaluator(predictionCol=cluster).evaluate(
            assemble_features(points, cols).withColumn(cluster, F.col(cluster).cast("double"))))
    return df.sparkSession.createDataFrame([(score,)], "silhouette_squared double")


def silhouette_curve(df: DataFrame, cols: list[str], ks: list[int], seed: int = 1) -> DataFrame:
    """One row per k > 1: the exact Euclidean silhouette of the k-means labels, all k advanced together."""
    points = weighted_points(df, cols)
    labelled = sweep_labels(points, cols, sweep_centres(points, cols, [k for k in ks if k > 1], seed))
    return silhouette_euclidean(labelled, cols, "cluster", run="k", weight="n")

"""Vectors on a plane, and in groups."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallyloom.session import at_once

# Starts of the clustering, and the fewest groups it makes.
STARTS = 10
MIN_CLUSTERS = 2


def fit_plane(vectors: DataFrame, vector: str = "embedding") -> PipelineModel:
    """Centre the vectors and fit their two principal components. One pass each; what
    comes to the driver has the size of the dimensions, not of the rows."""
    rows = vectors.select(array_to_vector(F.col(vector)).alias("vector"))
    return Pipeline(stages=[
        StandardScaler(inputCol="vector", outputCol="centred", withMean=True, withStd=False),
        PCA(k=2, inputCol="centred", outputCol="plane")]).fit(rows)


def project(model: PipelineModel, vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add coordinates ``x`` and ``y``, for the fitted rows or for a query."""
    placed = model.transform(vectors.withColumn("vector", array_to_vector(F.col(vector))))
    xy = vector_to_array("plane")
    return placed.withColumn("x", xy[0]).withColumn("y", xy[1]).drop("vector", "centred", "plane")


def cluster(vectors: DataFrame, clusters: int, vector: str = "embedding", seed: int = 0, starts: int = STARTS) -> DataFrame:
    """Add ``cluster``: the best of several k-means runs. The runs share one cached input and
    go side by side."""
    k = max(MIN_CLUSTERS, min(clusters, vectors.count()))
    rows = vectors.select(array_to_vector(F.col(vector)).alias("vector")).persist()
    try:
        models = at_once(rows.sparkSession, lambda i: KMeans(
            k=k, seed=seed + i, featuresCol="vector", predictionCol="cluster").fit(rows), range(starts))
    finally:
        rows.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(vectors.withColumn("vector", array_to_vector(F.col(vector)))).drop("vector")

"""Feature vectors: preparation, k-means training, nearest-centre assignment."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.vectors import nearest

def prepare(df: DataFrame, vector: str) -> DataFrame:
    """Add ``features``, the vector form that training reads."""
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def train_clusters(df: DataFrame, vector: str, k: int = 10, seed: int = 0, iterations: int = 20) -> KMeansModel:
    """Distributed k-means; only the k centres leave the executors."""
    features = prepare(df.select(vector), vector).select("features")
    return KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="features", predictionCol="cluster").fit(features)


def assign_trained(model: KMeansModel, df: DataFrame, vector: str) -> DataFrame:
    """Cluster of every row under a trained model."""
    return model.transform(prepare(df, vector)).drop("features")


def mean_per_label(df: DataFrame, vector: str, label: str) -> list[tuple[int, list[float]]]:
    """Mean vector of each label; one partial sum per label and task is all that moves.

    The means are a model, k x d numbers on the driver, as k-means itself holds its centres there.
    """
    labelled = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    means = prepare(labelled, vector).groupBy(label).agg(Summarizer.mean(F.col("features")).alias("centre"))
    return sorted((r[label], list(r["centre"])) for r in means.collect())


def distance_to(vector: str, centres: list[tuple[int, list[float]]], cluster: str) -> Column:
    """Distance of a row's vector to the centre of the cluster it is in."""
    chosen = F.create_map(*[part for k, c in centres for part in (F.lit(k), F.array(*[F.lit(float(x)) for x in c]))])
    apart = F.zip_with(vector, F.element_at(chosen, F.col(cluster)), lambda x, c: (x - c) * (x - c))
    return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda total, x: total + x))


def assign_nearest(df: DataFrame, vector: str, centres: list[tuple[int, list[float]]]) -> DataFrame:
    """Nearest given centre of every row, and the distance to it."""
    return df.withColumn("_best", nearest(vector, centres)).select(
        *df.columns, F.col("_best.cluster").alias("cluster"), F.col("_best.distance").alias("distance")
    )

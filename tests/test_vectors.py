"""Clusters and nearest centres against numpy."""

import numpy as np
import pytest

from tidemark.functions import vectors as functions
from tidemark.plans import vectors

SF = "/root/testdata/sf0.001"


def test_nearest_centre_equals_numpy(spark):
    rng = np.random.default_rng(0)
    points, centres = rng.normal(size=(200, 5)), rng.normal(size=(4, 5))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, v array<double>")
    found = vectors.assign_nearest(df, "v", [(k, c.tolist()) for k, c in enumerate(centres)]).collect()
    distance = np.linalg.norm(points[:, None] - centres[None], axis=2)
    assert [r["cluster"] for r in found] == distance.argmin(axis=1).tolist()
    assert np.allclose([r["distance"] for r in found], distance.min(axis=1))


def test_lower_cluster_wins_a_tie(spark):
    df = spark.createDataFrame([(0, [0.0])], "id int, v array<double>")
    assert vectors.assign_nearest(df, "v", [(7, [1.0]), (3, [-1.0])]).first()["cluster"] == 3


def test_null_vector_has_no_cluster(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, None), (2, [5.0])], "id int, v array<double>")
    found = vectors.assign_nearest(df, "v", [(0, [0.0]), (1, [4.0])]).orderBy("id").collect()
    assert [(r["cluster"], r["distance"]) for r in found] == [(0, 0.0), (None, None), (1, 1.0)]


def test_broken_vectors_have_no_cluster(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, None]), (2, [float("nan"), 0.0]), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, []), (6, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    found = vectors.assign_nearest(df, "v", [(3, [0.0, 0.0]), (7, [5.0, 5.0])]).orderBy("id").collect()
    assert [(r["cluster"], r["distance"]) for r in found] == [(3, 1.0)] + [(None, None)] * 6


@pytest.mark.parametrize("numbers", [1, 5, 12, 4_000_000])
def test_centres_in_blocks_give_the_same(spark, numbers, monkeypatch):
    monkeypatch.setattr(functions, "BLOCK_NUMBERS", numbers)
    rng = np.random.default_rng(2)
    points, centres = rng.integers(-3, 4, (60, 3)).astype(float), rng.integers(-3, 4, (9, 3)).astype(float)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, v array<double>")
    found = vectors.assign_nearest(df, "v", [(k, c.tolist()) for k, c in enumerate(centres)]).orderBy("id").collect()
    distance = np.linalg.norm(points[:, None] - centres[None], axis=2)
    assert [r["cluster"] for r in found] == distance.argmin(axis=1).tolist()


def test_mean_per_label(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], 1), ([3.0, 4.0], 1), ([5.0, 5.0], 0), ([9.0, 9.0], None)], "v array<double>, l int"
    )
    assert vectors.mean_per_label(df, "v", "l") == [(0, [5.0, 5.0]), (1, [2.0, 3.0])]


def test_kmeans_assigns_every_row_to_its_nearest_centre(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    model = vectors.train_clusters(df, "embedding", k=10, seed=1)
    found = vectors.assign_trained(model, df, "embedding").select("vec_id", "embedding", "cluster").collect()
    points = np.array([r["embedding"] for r in found], dtype=float)
    centres = np.array(model.clusterCenters())
    distance = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    chosen = np.array([r["cluster"] for r in found])
    assert len(found) == df.count() and centres.shape == (10, 64)
    assert np.allclose(distance[np.arange(len(found)), chosen], distance.min(axis=1))
    spread = ((points - points.mean(axis=0)) ** 2).sum()
    assert distance.min(axis=1).sum() < spread

"""Many K-Means models at once: the steps, the starts and what they reach."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from ledgerlark.operators import kmeans


def cloud(seed, n, centers=5):
    r = np.random.default_rng(seed)
    at = r.normal(size=(centers, 3)) * 6
    return at[r.integers(0, centers, n)] + r.normal(size=(n, 3))


def frame(spark, x, parts=4):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double, c double").repartition(parts)


def lloyd(x, centers, tol=1e-4, max_iter=300):
    for _ in range(max_iter):
        own = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == k].mean(axis=0) if (own == k).any() else c for k, c in enumerate(centers)])
        if np.sqrt(((moved - centers) ** 2).sum(axis=1)).max() <= tol:
            break
        centers = moved
    return centers


def test_models_together_move_as_each_alone(spark):
    x = cloud(1, 400)
    starts = [x[:3], x[10:17], np.concatenate([x[:2], [[99.0, 99.0, 99.0]]])]
    got = kmeans.fit_models(frame(spark, x), "id", ["a", "b", "c"], [(3, 0), (7, 0), (3, 1)], starts=starts)
    for model, start in zip(got, starts, strict=True):
        want = lloyd(x, start)
        assert model.centers == pytest.approx(want, abs=1e-9)
        gaps = ((x[:, None] - want[None]) ** 2).sum(axis=2).min(axis=1)
        assert model.inertia == pytest.approx(gaps.sum())


def test_no_worse_than_separate_fits_and_the_same_on_any_partitions(spark):
    x = cloud(2, 500, 6)
    df = frame(spark, x).cache()
    wanted = [(k, seed) for k in (3, 6) for seed in range(3)]
    got = kmeans.fit_models(df, "id", ["a", "b", "c"], wanted)
    again = kmeans.fit_models(df.repartition(1), "id", ["a", "b", "c"], wanted)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    for k in (3, 6):
        own = min(m.inertia for m in got if m.k == k)
        assert own <= 1.001 * min(KMeans(k=k, seed=s, maxIter=300).fit(vectors).summary.trainingCost for s in range(3))
        assert own == pytest.approx(min(m.inertia for m in again if m.k == k))


def test_passes_are_those_of_the_slowest_model(spark, monkeypatch):
    calls = []
    real = kmeans.cluster_sums
    monkeypatch.setattr(kmeans, "cluster_sums", lambda points, models: calls.append(len(models)) or real(points, models))
    models = kmeans.fit_models(frame(spark, cloud(3, 300)), "id", ["a", "b", "c"], [(k, s) for k in range(2, 6) for s in range(4)])
    assert len(calls) == 2 + max(m.moves for m in models) and calls[1] == 16 and calls == sorted(calls, reverse=True)


def test_packed_points_give_the_same_sums(spark):
    x = cloud(4, 300)
    points = frame(spark, x).selectExpr("a", "b", "c", "xxhash64(id) AS h")
    models = [x[:2], x[5:9]]
    own = {(r["model"], r["cluster"]): r.asDict() for r in kmeans.cluster_sums(points, models).collect()}
    packed = kmeans._packed(points)
    got = kmeans.cluster_sums(packed, models)
    assert len(got) == len(own) == 6 and all(r == pytest.approx(own[r["model"], r["cluster"]]) for r in got)


def test_few_points_nulls_and_none(spark):
    df = spark.createDataFrame([(1, 1.0, None, 0.0), (2, 1.0, 0.0, 0.0), (3, 5.0, 1.0, None)] * 3, "id long, a double, b double, c double")
    (model,) = kmeans.fit_models(df, "id", ["a", "b", "c"], [(4, 1)])
    assert model.inertia == 0 and sorted(map(tuple, model.centers)) == [(1, 0, 0), (5, 1, 0)]
    assert kmeans.fit_models(df.where("id < 0"), "id", ["a", "b", "c"], [(2, 1)]) == []

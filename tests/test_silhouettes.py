"""Euclidean silhouettes against the formula, and what their bounds promise."""

import random

import numpy as np
import pytest

from ledgerlark.operators import segments, silhouettes
from ledgerlark.session import Staging

SCHEMA = "x double, y double, a int, b int"


def exact(points, labels):
    x, labels = np.array(points, float), np.array([-1 if v is None else v for v in labels])
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i, mine].sum() / (mine.sum() - 1)
        b = min(gaps[i, labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


def cloud(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = r.randrange(3)
        rows.append((4.0 * k + r.gauss(0, 1), r.gauss(k, 1), k, r.choice([0, 1, None])))
    return [*rows, rows[0], rows[0], (90.0, -90.0, 9, 0)]


@pytest.mark.parametrize("slice_cells", [7, 10_000])
def test_exact_over_any_number_of_slices(spark, slice_cells):
    rows = cloud(1, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    got = silhouettes.silhouette_bounds(df, ["x", "y"], ["a", "b"], Staging(spark, "t"), slice_cells=slice_cells)
    for name, k in (("a", 2), ("b", 3)):
        want = exact([r[:2] for r in rows], [r[k] for r in rows])
        assert got[name].value == pytest.approx(want, abs=1e-9) and got[name].low == pytest.approx(want, abs=1e-9) == got[name].high


def test_every_refinement_holds_the_exact_value_and_comes_nearer(spark):
    rows = cloud(2, 400)
    seen = []

    def done(bounds):
        seen.append(bounds)
        return len(seen) == 6

    silhouettes.silhouette_bounds(spark.createDataFrame(rows, SCHEMA), ["x", "y"], ["a", "b"], Staging(spark, "t"), done, slice_cells=90)
    for name, k in (("a", 2), ("b", 3)):
        want = exact([r[:2] for r in rows], [r[k] for r in rows])
        assert all(s[name].low - 1e-9 <= want <= s[name].high + 1e-9 for s in seen)
        widths = [s[name].high - s[name].low for s in seen]
        assert widths == sorted(widths, reverse=True) and widths[-1] < widths[0] / 4


def test_the_first_bounds_are_close(spark):
    """Each cell's error is of second order: bounds by radii were 1.9 apart here."""
    rows, seen = cloud(4, 1500), []
    silhouettes.silhouette_bounds(
        spark.createDataFrame(rows, SCHEMA), ["x", "y"], ["a", "b"], Staging(spark, "t"), lambda b: seen.append(b) or True, slice_cells=300)
    for name, k in (("a", 2), ("b", 3)):
        assert seen[0][name].low <= exact([r[:2] for r in rows], [r[k] for r in rows]) <= seen[0][name].high < seen[0][name].low + 0.1


def test_no_rows_one_cluster_and_equal_rows(spark):
    def told(rows):
        found = silhouettes.silhouette_bounds(spark.createDataFrame(rows, SCHEMA), ["x", "y"], ["a", "b"], Staging(spark, "t"))
        return found["a"].value, found["b"].value

    assert told([]) == (None, None)
    assert told([(1.0, 1.0, 0, 1), (2.0, None, 0, 2)]) == (None, 0.0)
    assert told([(1.0, 1.0, 0, 1)] * 5 + [(1.0, 1.0, 1, 1)] * 5) == (0.0, None)


def test_the_choice_is_that_of_exact_silhouettes(spark):
    r = random.Random(5)
    rows = [(i, *(float(v) for v in (r.gauss(c % 5 * 6, 1), r.gauss(c % 2 * 5, 1), r.gauss(0, 1)))) for i in range(400) for c in [r.randrange(5)]]
    df = spark.createDataFrame(rows, "customer_id long, recency_days double, frequency double, monetary double")
    vectors, _ = segments.prepare_features(df)
    sweep = segments.choose_k(vectors, ks=range(3, 8), eligible=range(4, 8), restarts=2)
    points = {r.customer_id: r for r in vectors.collect()}
    values = {}
    for k, model in sweep.models.items():
        near = segments.nearest_center(vectors, [list(c) for c in model.clusterCenters()], [f"{c}_z" for c in segments.SEGMENT_FEATURES])
        placed = {r.customer_id: r.cluster for r in near.collect()}
        values[k] = exact([[points[i][f"{c}_z"] for c in segments.SEGMENT_FEATURES] for i in placed], list(placed.values()))
    assert sweep.best_k == max(range(4, 8), key=lambda k: (values[k], -k))
    assert sweep.silhouette == pytest.approx(values, abs=1e-9)

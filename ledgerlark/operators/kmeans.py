"""K-Means of many models at once: every number of clusters and every restart in the same passes.

The points are packed once, in blocks that Spark keeps and can make again. A pass reads them once. Its tasks hold the centres of all models that still move, and tell
per model and cluster how many points are nearest, their sum and their squared distances. A pass is
one stage without a shuffle: what returns is one row per task, model and cluster, and the driver adds
them up. So the cost of a sweep is that of its slowest model, not of all models one after the other.

Starts are those of k-means||: the first centre is drawn, then in ROUNDS passes 2 k points per model
are drawn with chances that grow with their squared distance to the centres drawn so far, as
Efraimidis-Spirakis keys from a hash of the point's key. The candidates, weighed by the points
nearest to them, are few, and k-means++ picks the starts among them. Draws depend on key and seed
alone, not on partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import tune

ROUNDS = 3
#: Points worked on at a time, so that what belongs to them stays in a core's cache.
_BATCH = 1 << 13


@dataclass
class Model:
    """Centres of one K-Means and the sum of squared distances to them; fewer than k where points are."""

    k: int
    seed: int
    centers: np.ndarray
    inertia: float = float("nan")
    moves: int = 0

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centers)


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] by hash of key and salt (the finishing steps of splitmix64)."""
    x = keys.view(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def _batches(batches):
    """(points, hashes of keys) in parts of _BATCH; the points as one row per feature."""
    for batch in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype(np.float64)
        keys = batch.columns[-1].to_numpy(zero_copy_only=False)
        for low in range(0, len(keys), _BATCH):
            yield x[:, low : low + _BATCH], keys[low : low + _BATCH]


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centers)))
    for d in range(x.shape[1]):
        out += (x[:, d, None] - centers[None, :, d]) ** 2
    return out


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the first on ties, and its squared distance."""
    own, best = np.zeros(x.shape[1], np.int64), np.full(x.shape[1], np.inf)
    square, part = np.empty(x.shape[1]), np.empty(x.shape[1])
    for j, center in enumerate(centers):
        square[:] = 0.0
        for values, at in zip(x, center, strict=True):
            np.subtract(values, at, out=part)
            np.multiply(part, part, out=part)
            np.add(square, part, out=square)
        np.copyto(own, j, where=square < best)
        np.minimum(best, square, out=best)
    return own, best


def _pack(batches):
    for x, keys in _batches(batches):
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([keys.tobytes()], pa.binary())], names=["x", "keys"])


def _packed(points: DataFrame) -> RDD:
    """Blocks of points and of the hashes of their keys, as `_batches` gives them."""
    def unpacked(row):
        keys = np.frombuffer(row["keys"], np.int64)
        return np.frombuffer(row["x"], np.float64).reshape(-1, len(keys)), keys

    return points.mapInArrow(_pack, "x binary, keys binary").rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def _step(models: list[np.ndarray]):
    """Per model and cluster of one task: points nearest (the first centre on ties), sums, squared distances."""
    every = np.concatenate(models)
    starts = np.concatenate([[0], np.cumsum([len(m) for m in models])])

    def run(blocks):
        n, cost, sums = np.zeros(len(every), np.int64), np.zeros(len(every)), np.zeros(every.shape)
        for x, _ in blocks:
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                own, gap = _nearest(x, every[a:b])
                n[a:b] += np.bincount(own, minlength=b - a)
                cost[a:b] += np.bincount(own, weights=gap, minlength=b - a)
                for d, values in enumerate(x):
                    sums[a:b, d] += np.bincount(own, weights=values, minlength=b - a)
        met = np.flatnonzero(n)
        model = np.searchsorted(starts, met, "right") - 1
        yield model.astype(np.int32), (met - starts[model]).astype(np.int32), n[met], cost[met], *sums[met].T

    return run


def cluster_sums(points: DataFrame | RDD, models: list[np.ndarray]) -> DataFrame | list[dict]:
    """model, cluster, n, cost and s0, s1, ...: one pass over `points`, for all models given by their centres.

    `points` has the features as doubles and, last, a hash of the key. Clusters without points have no row.
    Of packed points the rows come added up at the driver, where there is one per task, model and cluster.
    """
    names = ["model", "cluster", "n", "cost", *[f"s{d}" for d in range(models[0].shape[1])]]
    step = _step(models)
    if isinstance(points, RDD):
        found: dict[tuple, list] = {}
        for part in points.mapPartitions(step).collect():
            for model, cluster, *sums in zip(*(c.tolist() for c in part), strict=True):
                old = found.get((model, cluster))
                found[model, cluster] = sums if old is None else [a + b for a, b in zip(old, sums, strict=True)]
        return [dict(zip(names, (*key, *sums), strict=True)) for key, sums in found.items()]

    def told(batches):
        for arrays in step(_batches(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    parts = points.mapInArrow(told, ", ".join(["model int", "cluster int", "n long", *[f"{c} double" for c in names[3:]]]))
    return parts.groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in names[2:]])


def _draw(models: list[tuple[int, int, np.ndarray]], turn: int):
    """The best keys of one task, for each model as many as it draws: (model, keys, points)."""

    def run(blocks):
        best = [(np.zeros(0), np.zeros((0, 0))) for _ in models]
        for x, keys in blocks:
            for i, (k, seed, centers) in enumerate(models):
                key = -np.log(_uniform(keys, seed * 1_000_003 + k * 1009 + turn))
                if len(centers):
                    _, gap = _nearest(x, centers)
                    with np.errstate(divide="ignore"):
                        key = np.where(gap > 0, key / gap, np.inf)
                wanted = 2 * k if len(centers) else 1
                # Only keys that can be among the best are sorted.
                cut = np.partition(key, wanted - 1)[wanted - 1] if len(key) > wanted else np.inf
                own = (key <= cut) & np.isfinite(key)
                key, rows = np.concatenate([best[i][0], key[own]]), np.concatenate([best[i][1].reshape(-1, len(x)), x.T[own]])
                first = np.lexsort((*rows.T, key))[:wanted]
                best[i] = key[first], rows[first]
        for i, (key, rows) in enumerate(best):
            if len(key):
                yield i, key, rows

    return run


def _among(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ and a few moves among the candidates of one model."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < k:
        gap = _squares(candidates, candidates[chosen]).min(axis=1) * weights
        if not gap.sum():
            break
        chosen.append(int(rng.choice(len(candidates), p=gap / gap.sum())))
    centers = candidates[chosen]
    for _ in range(20):
        own = _squares(candidates, centers).argmin(axis=1)
        total = np.bincount(own, weights=weights, minlength=len(centers))
        moved = np.column_stack([np.bincount(own, weights=weights * c, minlength=len(centers)) for c in candidates.T])
        centers = np.where(total[:, None] > 0, moved / np.maximum(total, 1e-300)[:, None], centers)
    return centers


def _starts(points: RDD, wanted: list[tuple[int, int]], width: int) -> list[np.ndarray]:
    drawn = [np.zeros((0, width)) for _ in wanted]
    for turn in range(ROUNDS + 1):
        models = [(k, seed, own) for (k, seed), own in zip(wanted, drawn, strict=True)]
        # At most twice the clusters of a model come back from a task.
        found: dict[int, list] = {}
        for model, key, rows in points.mapPartitions(_draw(models, turn)).collect():
            found.setdefault(model, []).append((key, rows))
        for model, parts in found.items():
            key, rows = (np.concatenate(column) for column in zip(*parts, strict=True))
            first = np.lexsort((*rows.T[::-1], key))[: 2 * wanted[model][0] if len(drawn[model]) else 1]
            drawn[model] = np.unique(np.concatenate([drawn[model], rows[first]]), axis=0)
    if not all(len(d) for d in drawn):
        return []
    weights = [np.zeros(len(d)) for d in drawn]
    for r in cluster_sums(points, drawn):
        weights[r["model"]][r["cluster"]] = r["n"]
    return [_among(d, w, k, seed) for d, w, (k, seed) in zip(drawn, weights, wanted, strict=True)]


def fit_models(
    points: DataFrame, key: str, features: list[str], wanted: list[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4,
    starts: list[np.ndarray] | None = None,
) -> list[Model]:
    """One model for each (k, seed) of `wanted`, from `starts` if given. Read several times: pass a stored table.

    A model is done when no centre moves further than `tol`. Nulls count as 0, a cluster that loses
    all points keeps its centre, and without points there are no models.
    """
    tune(points.sparkSession)
    plain = points.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)], F.xxhash64(key).alias("h"))
    blocks = _packed(plain)
    try:
        if starts is None:
            starts = _starts(blocks, wanted, len(features))
        models = [Model(k, seed, np.array(own, float)) for (k, seed), own in zip(wanted, starts, strict=False)]
        return _moved(blocks, models, max_iter, tol)
    finally:
        blocks.unpersist()


def _moved(blocks: RDD, models: list[Model], max_iter: int, tol: float) -> list[Model]:
    moving = list(range(len(models)))
    while moving:
        rows = cluster_sums(blocks, [models[i].centers for i in moving])
        still = []
        for place, i in enumerate(moving):
            model = models[i]
            own = [r for r in rows if r["model"] == place]
            if not own:
                continue
            model.inertia = sum(r["cost"] for r in own)
            moved = model.centers.copy()
            for r in own:
                moved[r["cluster"]] = [r[f"s{d}"] / r["n"] for d in range(moved.shape[1])]
            far = float(np.sqrt(((moved - model.centers) ** 2).sum(axis=1)).max())
            if far > tol and model.moves < max_iter:
                model.centers, model.moves = moved, model.moves + 1
                still.append(i)
        moving = still
    return models

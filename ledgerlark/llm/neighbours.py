"""Approximate nearest neighbours: a vantage-point tree per shard.

A small vantage-point tree over a sample of at most SAMPLE_ROWS rows (and SAMPLE_VALUES components)
cuts space into at most LEAVES regions; every row is dealt to its region, and large regions are split
by the hash of the id into shards of about SHARD_ROWS rows, so a crowd of equal vectors spreads too.
The sample shapes the regions only: no row is left out, whatever it holds.

A query first searches the shards of its own region. The distance of the k-th best found there bounds
what it still looks for, and only regions that the triangle inequality, with that bound scaled by
`factor`, does not exclude are visited. Each shard builds its tree once and the queries that reach it
stream by; nodes split the others by their distance from a vantage point, and a branch is left out
by the same rule. Factor 1 is exact search, smaller ones skip more.

Vectors that are null, all zero, or hold null, NaN or infinite components take no part; vectors of
different lengths never meet. Ties go to the smaller id. A table without queries gives no rows,
and a query with fewer than k candidates gives what there is. Rows of one id are one row: of different
vectors, the smallest in the order of arrays stands for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.llm.common import by_batch
from ledgerlark.session import Staging, tune

SHARD_ROWS, LEAF_ROWS = 2048, 64
LEAVES, SAMPLE_ROWS, SAMPLE_VALUES = 1024, 16384, 1 << 23
FACTOR = 0.25
_PLACE = ["n", "region", "part"]


class Tree:
    """A vantage-point tree over the rows of a matrix; rows are in ascending order of id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        point, rest = rows[0], rows[1:]
        d = distances(self.vectors[point][None], self.vectors[rest])[0]
        middle = np.median(d)
        inside = d <= middle
        if inside.all():
            inside = d < middle
            if not inside.any():
                return rows
        bounds = (d[inside].min(), d[inside].max(), d[~inside].min(), d[~inside].max())
        return point, bounds, self._build(rest[inside]), self._build(rest[~inside])

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, factor: float, limit: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Distances (inf where there is none) and ids of the k nearest rows of each query but its own id.

        What lies beyond a query's `limit` need not be found.
        """
        self.k, self.factor, self.limit = k, factor, limit
        self.queries, self.own = queries, own
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self._visit(self.root, np.arange(len(queries)))
        return self.best, self.found

    def _meet(self, rows: np.ndarray, active: np.ndarray) -> np.ndarray:
        d = distances(self.queries[active], self.vectors[rows])
        ids = np.broadcast_to(self.ids[rows], d.shape)
        d_all = np.concatenate([self.best[active], np.where(ids == self.own[active][:, None], np.inf, d)], axis=1)
        i_all = np.concatenate([self.found[active], np.where(ids == self.own[active][:, None], np.iinfo(np.int64).max, ids)], axis=1)
        order = np.lexsort((i_all, d_all), axis=1)[:, : self.k]
        self.best[active] = np.take_along_axis(d_all, order, axis=1)
        self.found[active] = np.take_along_axis(i_all, order, axis=1)
        return d

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            for low in range(0, len(active), 128):
                self._meet(node, active[low : low + 128])
            return
        point, bounds, inside, outside = node
        d = self._meet(np.array([point]), active)[:, 0]
        near = d <= (bounds[1] + bounds[2]) / 2
        self._visit(inside, active[near])
        self._visit(outside, active[~near])
        reach = _reach(np.minimum(self.best[active, -1], self.limit[active]), self.factor, d)
        self._visit(outside, active[near & (d + reach >= bounds[2]) & (d - reach <= bounds[3])])
        self._visit(inside, active[~near & (d + reach >= bounds[0]) & (d - reach <= bounds[1])])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, from differences: equal vectors are at exactly 0."""
    return np.sqrt(np.square(a[:, None, :] - b[None, :, :]).sum(axis=2))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _reach(radius: np.ndarray, factor: float, d: np.ndarray) -> np.ndarray:
    """How far from its side of a border a query looks; a hair more, for distances are rounded."""
    return factor * radius + 1e-12 * (d + np.where(np.isinf(radius), 0.0, radius))


def _regions(points: np.ndarray, depth: int):
    """A tree of (vantage point, border, inside, outside) whose leaves are numbers of regions."""
    count = 0

    def grow(rows: np.ndarray, depth: int):
        nonlocal count
        if depth and len(rows) > 1:
            d = distances(points[rows[0]][None], points[rows[1:]])[0]
            border = float(np.median(d))
            inside = d <= border
            if not inside.all():
                return points[rows[0]], border, grow(rows[1:][inside], depth - 1), grow(rows[1:][~inside], depth - 1)
        count += 1
        return count - 1

    return grow(np.arange(len(points)), depth)


def _reached(node, points: np.ndarray, reach, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(region, rows of `points` that come to it): with `reach` None their own, else (radii, factor) all in reach."""
    if not len(rows):
        return
    if isinstance(node, int):
        yield node, rows
        return
    point, border, inside, outside = node
    d = np.concatenate([distances(points[rows[low : low + 1024]], point[None])[:, 0] for low in range(0, len(rows), 1024)])
    near = d <= border
    if reach is None:
        left, right = near, ~near
    else:
        far = _reach(reach[0][rows], reach[1], d)
        left, right = near | (d - far <= border), ~near | (d + far >= border)
    yield from _reached(inside, points, reach, rows[left])
    yield from _reached(outside, points, reach, rows[right])


def _sample(rows: DataFrame, n: int, longest: int) -> dict:
    """Regions by length of vectors, from the rows whose hashes are smallest; other lengths have one region."""
    depth = min(LEAVES.bit_length() - 1, max(0, -(-n // SHARD_ROWS) - 1).bit_length())
    size = max(2, min(SAMPLE_ROWS, 16 << depth, SAMPLE_VALUES // max(1, longest)))
    taken: dict[int, list] = {}
    if depth:
        for r in rows.select("n", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).toLocalIterator():
            taken.setdefault(r.n, []).append(r.vector)
    return {length: _regions(np.array(points), depth) for length, points in taken.items()}


def _by_length(batch: pa.RecordBatch):
    """(length, positions) of the rows of a batch."""
    n = batch.column("n").to_numpy()
    for length in np.unique(n):
        yield int(length), np.flatnonzero(n == length)


def _deal(trees: dict):
    """Adds the region of each row to vec_id, vector and n."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        region = np.zeros(batch.num_rows, np.int32)
        for length, at in _by_length(batch):
            points = _matrix(batch.column("vector").take(pa.array(at)))
            for number, rows in _reached(trees.get(length, 0), points, None, np.arange(len(at))):
                region[at[rows]] = number
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], names=[*batch.schema.names, "region"])

    return run


def _beyond(trees: dict, factor: float):
    """One row for each region in reach of a query but its own."""

    def run(batch: pa.RecordBatch):
        home, limits = batch.column("region").to_numpy(), batch.column("limit").to_numpy()
        for length, at in _by_length(batch):
            points = _matrix(batch.column("vector").take(pa.array(at)))
            for number, rows in _reached(trees.get(length, 0), points, (limits[at], factor), np.arange(len(at))):
                chosen = at[rows][home[at[rows]] != number]
                if len(chosen):
                    out = batch.take(pa.array(chosen))
                    yield out.set_column(out.schema.names.index("region"), "region", pa.array(np.full(len(chosen), number, np.int32)))

    return run


def _stream(k: int, factor: float):
    """Searches sorted rows: of each shard first the vectors, of which a tree is built, then the queries."""

    def run(batches):
        shard, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in (*_PLACE, "asks")], axis=1)
            cuts = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                place, asks = tuple(places[low, :3]), places[low, 3]
                if place != shard:
                    shard, held, tree = place, [], None
                ids, points = batch.column("id").slice(low, high - low).to_numpy(), _matrix(batch.column("vector").slice(low, high - low))
                if not asks:
                    held.append((ids, points))
                    continue
                if held:
                    ordered = np.argsort(own := np.concatenate([i for i, _ in held]), kind="stable")
                    tree, held = Tree(np.concatenate([p for _, p in held])[ordered], own[ordered]), []
                if tree is None:
                    continue
                limit = batch.column("limit").slice(low, high - low).to_numpy()
                best, found = tree.search(points, ids, k, factor, limit)
                real = np.isfinite(best) & (best <= limit[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, k).reshape(-1, k)[real]), pa.array(found[real]), pa.array(best[real])],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vector (doubles) and its length, of the vectors that take part."""
    vector = F.col(vector_column).cast("array<double>")
    limit = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"), F.size(vector).alias("n")
    )


def nearest(
    vectors: DataFrame, work: Staging, every: int = 100, k: int = 10, factor: float = FACTOR,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score (distance): the k nearest of every row whose id `every` divides."""
    spark = tune(vectors.sparkSession)
    one = usable(vectors, id_column, vector_column).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = work.table(one.withColumn("n", F.size("vector")), "vectors")
    n, longest = rows.agg(F.count(F.lit(1)), F.max("n")).first()
    trees = _sample(rows, n, longest or 0)
    dealt = work.table(rows.mapInArrow(by_batch(_deal(trees)), "vec_id long, vector array<double>, n int, region int"), "dealt")
    work.drop("vectors")
    split = dealt.groupBy("n", "region").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("parts"))
    split = work.table(split, "split")
    infinite = F.lit(float("inf"))
    placed = dealt.join(split, ["n", "region"]).select(
        "n", "region", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asks"),
        F.col("vec_id").alias("id"), "vector", infinite.alias("limit"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def searched(queries: DataFrame, name: str) -> DataFrame:
        """The k nearest found for (n, region, id, vector, limit) in the shards of the region."""
        asking = queries.join(split, ["n", "region"]).select(
            "n", "region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "id", "vector", "limit"
        )
        together = placed.union(asking).repartitionById(tasks, F.pmod(F.col("region") + F.col("part"), F.lit(tasks)).cast("int"))
        hits = together.sortWithinPartitions(*_PLACE, "asks").mapInArrow(_stream(k, factor), "query_id long, vec_id long, score double")
        return work.table(_best(hits, k).drop("rank"), name)

    asked = dealt.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "id")
    home = searched(asked.withColumn("limit", infinite), "home")
    bound = home.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("limit"))
    bounded = asked.join(bound, "id", "left").select("n", "region", "id", "vector", F.coalesce("limit", infinite).alias("limit"))
    beyond = bounded.mapInArrow(by_batch(_beyond(trees, factor)), bounded.schema)
    return _best(home.union(searched(beyond, "beyond")), k).select("query_id", "rank", "vec_id", "score")


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

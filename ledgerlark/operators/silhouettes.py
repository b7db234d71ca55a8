"""Euclidean silhouettes of all rows, with certified bounds.

A silhouette needs, for every row, the sum of its distances to every cluster. Rows are gathered
into cells, boxes of the space of the features, and within a cell into groups of equal labels: a
group stands at the mean of its rows, and `q` is the sum of their squared distances from there. The
distance d of a row to the mean, times the group's n rows, is at most the sum of its distances to them
(a distance is convex), and less than it by at most q / 2d (the root of a sum lies below its tangent)
and sqrt(n q). From these sums follow a lower and an upper bound of each silhouette and of their mean.

Cells are halved along every feature, but only those that hold more than half of a cell's usual
share of `q`, until the bounds are as close as asked or settle what was asked for. A group of
equal rows has no error, so at its end the refinement is the exact silhouette. Every task holds
SLICE_CELLS groups and compares its rows with a block of them at a time; more groups are further passes over
the rows, whose partial sums are written between them. What reaches the driver at a time is one slice of groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import Staging, tune

SLICE_CELLS, START_PARTS, MAX_HALVINGS = 1 << 18, 16, 40
#: Groups in a pass before it is worth one, and different rows that are the groups at once.
WORTH_CELLS, FEW_ROWS = 2048, 8192
#: Rows and groups compared at a time, so that their distances stay in a core's cache.
_ROWS, _GROUPS = 16, 4096


@dataclass
class Bounds:
    """Mean silhouette of a label column: between `low` and `high`, taken to the cells' centres `value`."""

    value: float | None
    low: float | None
    high: float | None


def _placed(points: DataFrame, features: list[str], origin: list[float], side: list[float]) -> DataFrame:
    """The cell of each row at its own number of halvings."""
    places = [F.floor((F.col(f) - F.lit(o)) * F.pow(F.lit(2.0), F.col("_halved")) / F.lit(s)) for f, o, s in zip(features, origin, side, strict=True)]
    exact = F.array(*[F.col(f) for f in features])
    return points.withColumn("_cell", F.when(F.col("_halved") >= MAX_HALVINGS, F.xxhash64(exact)).otherwise(F.xxhash64(*places)))


def _groups(placed: DataFrame, features: list[str], places: list[str]) -> DataFrame:
    """One row per cell and labels: mean, rows and the sum of their squared distances from the mean."""
    alike = [F.min(f) == F.max(f) for f in features]
    same = alike[0]
    for a in alike[1:]:
        same = same & a
    spread = [F.var_pop(f) for f in features]
    return placed.groupBy("_halved", "_cell", *places).agg(
        F.array(*[F.when(a, F.min(f)).otherwise(F.avg(f)) for f, a in zip(features, alike, strict=True)]).alias("centre"),
        F.count(F.lit(1)).cast("double").alias("n"),
        F.when(same, F.lit(0.0)).otherwise(F.count(F.lit(1)) * sum(spread[1:], spread[0])).alias("q"),
    )


@dataclass
class _Slice:
    """Groups in the order of their labels: segments of equal labels, and the clusters each segment belongs to."""

    centres: np.ndarray
    n: np.ndarray
    q: np.ndarray
    dev: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    member: np.ndarray

    @staticmethod
    def of(part: pa.Table, places: list[str], clusters: int) -> _Slice:
        own = np.column_stack([part.column(p).to_numpy() for p in places]).reshape(part.num_rows, len(places))
        order = np.lexsort(own.T)
        own = own[order]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        member = np.zeros((len(starts), clusters))
        for p in range(len(places)):
            member[np.arange(len(starts)), own[starts, p]] = 1.0
        centres = part.column("centre").combine_chunks().flatten().to_numpy().reshape(part.num_rows, -1)
        n, q = part.column("n").to_numpy()[order], part.column("q").to_numpy()[order]
        return _Slice(centres[order].T.copy(), n, q, np.sqrt(n * q), starts, np.append(starts[1:], len(n)), member)

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x clusters) distances of some rows to the means, times the rows there, and by how much their sums may be more."""
        least, more = np.zeros((len(x), len(self.starts))), np.zeros((len(x), len(self.starts)))
        both = np.empty((2, len(x), min(_GROUPS, len(self.n))))
        for low in range(0, len(self.n), _GROUPS):
            high = min(low + _GROUPS, len(self.n))
            gaps, part = both[:, :, : high - low]
            for d, centre in enumerate(self.centres):
                into = part if d else gaps
                np.subtract(x[:, d, None], centre[None, low:high], out=into)
                np.multiply(into, into, out=into)
                if d:
                    np.add(gaps, part, out=gaps)
            np.sqrt(gaps, out=gaps)
            off = self.q[low:high].any()
            if off:
                np.maximum(gaps, 1e-300, out=part)
                with np.errstate(over="ignore"):
                    np.divide(self.q[low:high] / 2, part, out=part)
                np.minimum(part, self.dev[low:high], out=part)
            for k in range(np.searchsorted(self.stops, low, "right"), np.searchsorted(self.starts, high)):
                a, b = max(self.starts[k], low) - low, min(self.stops[k], high) - low
                least[:, k] += gaps[:, a:b] @ self.n[low + a : low + b]
                if off:
                    more[:, k] += part[:, a:b].sum(axis=1)
        return least @ self.member, more @ self.member


def _added(shared, width: int, clusters: int):
    """Adds to a batch of rows (features, places, sums) what one slice of groups tells."""

    def run(batches):
        told = shared.value
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]])
            sums = batch.columns[-1].flatten().to_numpy().reshape(len(x), 2 * clusters).copy()
            for low in range(0, len(x), _ROWS):
                least, more = told.sums(x[low : low + _ROWS])
                sums[low : low + _ROWS, :clusters] += least
                sums[low : low + _ROWS, clusters:] += more
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * 2 * clusters)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(sums.reshape(-1)))], names=batch.schema.names)

    return run


def _scores(sizes: list[list[int]], width: int):
    """One row per task and label column: rows, and the sums of their lowest, middle and highest silhouettes."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sizes])])

    def run(batches):
        total = np.zeros((len(sizes), 4))
        for batch in batches:
            sums = batch.columns[-1].flatten().to_numpy().reshape(batch.num_rows, 2, -1)
            at = np.arange(batch.num_rows)
            for k, size in enumerate(sizes):
                n, own = np.array(size, float), batch.columns[width + k].to_numpy() - first[k]
                least, more = sums[:, 0, first[k] : first[k + 1]], sums[:, 1, first[k] : first[k + 1]]
                found = {}
                # About two thirds of `more` if the rows of a group lie alike in all directions.
                for name, share in (("low", 0.0), ("middle", 2 / 3), ("high", 1.0)):
                    every = least + share * more
                    outer = every / n
                    outer[at, own] = np.inf
                    found[name] = every[at, own] / np.maximum(n[own] - 1, 1), outer.min(axis=1)
                total[k, 0] += batch.num_rows
                # The lowest silhouette has the nearest other cluster nearest and the own one farthest.
                for j, (inner, outer) in enumerate((("high", "low"), ("middle", "middle"), ("low", "high")), 1):
                    a, b = found[inner][0], found[outer][1]
                    widest = np.maximum(a, b)
                    total[k, j] += np.where((n[own] == 1) | (widest == 0), 0.0, (b - a) / np.where(widest == 0, 1.0, widest)).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sizes), dtype=np.int32)), pa.array(total[:, 0].astype(np.int64)), *[pa.array(total[:, j]) for j in (1, 2, 3)]],
            names=["place", "rows", "low", "middle", "high"],
        )

    return run


def _measured(
    rows: DataFrame, groups: DataFrame, sizes: list[list[int]], places: list[str], work: Staging, name: str, slice_cells: int
) -> list[Bounds]:
    """Bounds of every label column from the given groups; `rows` has the features and its cluster's place in each column."""
    spark, clusters, width = rows.sparkSession, sum(len(s) for s in sizes), len(rows.columns) - len(places)
    slices = max(1, -(-groups.count() // slice_cells))
    # Dealt by the cell's hash; a slice is about slice_cells rows, and only one is at the driver at a time.
    dealt = groups.withColumn("_slice", F.pmod(F.xxhash64("_cell", "_halved", *places), F.lit(slices)))
    sums = rows.withColumn("sums", F.array_repeat(F.lit(0.0), 2 * clusters))
    kinds = ", ".join([*[f"`{c}` {kind}" for c, kind in rows.dtypes], "sums array<double>"])
    for number in range(slices):
        part = dealt.where(F.col("_slice") == number).select("centre", "n", "q", *places).toArrow()
        shared = spark.sparkContext.broadcast(_Slice.of(part, places, clusters))
        sums = sums.mapInArrow(_added(shared, width, clusters), kinds)
        if number + 1 < slices:
            sums = work.table(sums, f"{name}-{number}")
            if number:
                work.drop(f"{name}-{number - 1}")
    found = sums.mapInArrow(_scores(sizes, width), "place int, rows long, low double, middle double, high double").groupBy("place").agg(
        *[(F.sum(c) / F.sum("rows")).alias(c) for c in ("middle", "low", "high")]
    ).orderBy("place").collect()
    if slices > 1:
        work.drop(f"{name}-{slices - 2}")
    return [Bounds(r["middle"], r["low"], r["high"]) for r in found]


def _within(now: Bounds, before: Bounds | None) -> Bounds:
    """What both bounds say."""
    if before is None:
        return now
    low, high = max(now.low, before.low), min(now.high, before.high)
    return Bounds(min(max(now.value, low), high), low, high)


def silhouette_bounds(
    points: DataFrame, features: list[str], labels: list[str], work: Staging, done: Callable[[dict[str, Bounds]], bool] | None = None,
    slice_cells: int = SLICE_CELLS,
) -> dict[str, Bounds]:
    """Bounds of the mean Euclidean silhouette of each label column over all rows.

    `done` is asked after every refinement that is worth a pass; without it the exact silhouettes are computed. Null
    features count as 0, null labels as a cluster of their own. A row alone in its cluster, and one
    whose distances are all 0, score 0. A single cluster, or no row, has no silhouette.
    """
    tune(points.sparkSession)
    plain = points.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features], *labels)
    plain = work.table(plain, "points")
    # One row per cluster of each column.
    clusters, sizes = {}, {}
    for c in labels:
        found = plain.groupBy(c).count().orderBy(c).collect()
        clusters[c], sizes[c] = [r[c] for r in found], [r["count"] for r in found]
    known = [c for c in labels if len(clusters[c]) > 1]
    out = {c: Bounds(None, None, None) for c in labels}
    if not known:
        return out
    box = plain.agg(*[F.min(f).alias(f"l{i}") for i, f in enumerate(features)], *[F.max(f).alias(f"h{i}") for i, f in enumerate(features)]).first()
    origin = [box[f"l{i}"] for i in range(len(features))]
    side = [((box[f"h{i}"] - o) or 1.0) / START_PARTS for i, o in enumerate(origin)]
    places = []
    for c in known:
        place = F.lit(None).cast("int")
        for k, value in enumerate(clusters[c]):
            place = F.when(F.col(c).eqNullSafe(F.lit(value)), k + sum(len(clusters[d]) for d in known[: known.index(c)])).otherwise(place)
        places.append(place)
    names = [f"_own{k}" for k in range(len(known))]
    plain = work.table(plain.select(*features, *[p.alias(n) for p, n in zip(places, names, strict=True)]), "rows")
    work.drop("points")
    # Where all different rows are few, or the exact values are wanted, they are the cells at once.
    few = done is None or plain.select(*features).distinct().limit(FEW_ROWS + 1).count() <= min(FEW_ROWS, slice_cells)
    now = plain.withColumn("_halved", F.lit(MAX_HALVINGS if few else 0))
    turn, told = 0, {}
    while True:
        placed = _placed(now, features, origin, side)
        groups = work.table(_groups(placed, features, names), f"cells-{turn}")
        left = groups.where((F.col("q") > 0) & (F.col("_halved") < MAX_HALVINGS)).groupBy("_halved", "_cell").agg(F.sum("q").alias("q"))
        left = left.agg(F.avg("q").alias("usual"), F.count(F.lit(1)).alias("open")).first()
        if not left["open"] or groups.count() >= min(WORTH_CELLS, slice_cells // 4):
            found = _measured(plain, groups, [sizes[c] for c in known], names, work, f"sums-{turn}", slice_cells)
            told = {c: _within(b, told.get(c)) for c, b in zip(known, found, strict=True)}
            if not left["open"] or (done and done(out | told)):
                return out | told
        cells = groups.groupBy("_halved", "_cell").agg(F.sum("q").alias("q"))
        split = cells.where((F.col("q") > F.lit(left["usual"] / 2)) & (F.col("_halved") < MAX_HALVINGS)).select("_halved", "_cell", F.lit(1).alias("_more"))
        next_ = placed.join(split, ["_halved", "_cell"], "left").withColumn("_halved", F.col("_halved") + F.coalesce("_more", F.lit(0)))
        now = work.table(next_.select(*features, *names, "_halved"), f"points-{turn}")
        work.drop(f"cells-{turn}", *([f"points-{turn - 1}"] if turn else []))
        turn += 1


def euclidean_silhouette(points: DataFrame, features: list[str], labels: list[str], work: Staging) -> DataFrame:
    """(labels, silhouette) of each label column: exact, over all rows."""
    found = silhouette_bounds(points, features, labels, work)
    return points.sparkSession.createDataFrame([(c, found[c].value) for c in labels], "labels string, silhouette double")


def choice_is_certain(bounds: dict[str, Bounds], eligible: list[str]) -> bool:
    """Whether the highest silhouette of the eligible columns is higher than all others can be, or ties are exact."""
    known = [bounds[c] for c in eligible if bounds[c].value is not None]
    if len(known) < 2:
        return True
    best = max(known, key=lambda b: b.value)
    return all(b is best or b.high < best.low for b in known)


def choose_labels(points: DataFrame, features: list[str], labels: list[str], work: Staging) -> DataFrame:
    """(labels, silhouette) of the column with the highest silhouette, the first of the list on ties."""
    found = silhouette_bounds(points, features, labels, work)
    known = [c for c in labels if found[c].value is not None]
    rows = [(c, found[c].value) for c in [max(known, key=lambda c: (found[c].value, -labels.index(c)))]] if known else []
    return points.sparkSession.createDataFrame(rows, "labels string, silhouette double")

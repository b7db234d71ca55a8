"""K-Means segmentation of customers with names given by rank."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.functions.numeric import mean
from ledgerlark.operators.kmeans import Model, fit_models
from ledgerlark.operators.silhouettes import choice_is_certain, silhouette_bounds
from ledgerlark.session import Staging, tune

SEGMENT_FEATURES = ["recency_days", "frequency", "monetary"]
MAX_CLUSTERS = 1000


@dataclass
class Scaler:
    """Mean and population deviation per column; a constant column scales to 0."""

    means: dict[str, float]
    deviations: dict[str, float]

    def apply(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns({
            c + suffix: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - m) / (self.deviations[c] or 1.0)
            for c, m in self.means.items()
        })


def fit_scaler(df: DataFrame, cols: list[str]) -> Scaler:
    """One aggregate; only the parameters of the columns reach the driver."""
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    row = df.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in value.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in value.items()],
    ).first()
    return Scaler({c: row[f"m_{c}"] or 0.0 for c in cols}, {c: row[f"s_{c}"] or 0.0 for c in cols})


def prepare_features(rfm: DataFrame, cols: list[str] = SEGMENT_FEATURES) -> tuple[DataFrame, Scaler]:
    """Scaled copies of the columns (`*_z`) and the vector `features`."""
    scaler = fit_scaler(rfm, cols)
    scaled = scaler.apply(rfm)
    return VectorAssembler(inputCols=[f"{c}_z" for c in cols], outputCol="features").transform(scaled), scaler


def fit_kmeans(points: DataFrame, key: str, features: list[str], ks, seed: int = 42, restarts: int = 10, max_iter: int = 300) -> dict[int, Model]:
    """The model with the lowest inertia of several seeded starts for every k, lowest seed on ties."""
    fitted = fit_models(points, key, features, [(k, seed + start) for k in ks for start in range(restarts)], max_iter)
    return {k: min((m for m in fitted if m.k == k), key=lambda m: (m.inertia, m.seed)) for k in sorted({m.k for m in fitted})}


def squared_silhouette(points: DataFrame, features: list[str], label_cols: list[str]) -> DataFrame:
    """(labels, silhouette) per label column over all rows, with squared Euclidean distance.

    The mean squared distance of a point to a cluster follows from the cluster's size, sum and sum
    of squares, so one aggregate per label column and one pass over the rows are enough. What
    reaches the driver is one row per cluster, at most MAX_CLUSTERS. A point alone in its cluster
    scores 0; a single cluster has no silhouette.
    """
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    square = reduce(add, [v * v for v in x])
    scores = []
    for column in label_cols:
        found = points.groupBy(column).agg(
            F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
        ).limit(MAX_CLUSTERS + 1).collect()
        if len(found) > MAX_CLUSTERS:
            raise ValueError(f"{column} has more than {MAX_CLUSTERS} values")
        if len(found) < 2:
            scores.append(F.lit(None).cast("double"))
            continue
        label = F.col(column)
        inner, outer = F.lit(0.0), []
        alone = F.lit(False)
        for row in found:
            dot = reduce(add, [v * row[f"s{i}"] for i, v in enumerate(x)])
            total = F.greatest(square * float(row["n"]) - 2 * dot + row["q"], F.lit(0.0))
            own = label.eqNullSafe(F.lit(row[column]))
            inner = F.when(own, total / max(row["n"] - 1, 1)).otherwise(inner)
            outer.append(F.when(~own, total / row["n"]))
            alone = alone | (own & F.lit(row["n"] == 1))
        near = F.least(*outer)
        scores.append(F.avg(F.when(alone | (F.greatest(inner, near) == 0), 0.0).otherwise((near - inner) / F.greatest(inner, near))))
    means = points.agg(*[s.alias(f"s{i}") if s is not None else s for i, s in enumerate(scores)])
    return means.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("labels"), F.col(f"s{i}").alias("silhouette")) for i, c in enumerate(label_cols)
    ])))


@dataclass
class Sweep:
    """Models per k with their inertia and silhouette, and the k chosen."""

    models: dict[int, Model]
    inertia: dict[int, float]
    silhouette: dict[int, float]
    best_k: int

    def table(self, spark) -> DataFrame:
        rows = [(k, self.inertia[k], self.silhouette[k], k == self.best_k) for k in sorted(self.models)]
        return spark.createDataFrame(rows, "k int, inertia double, silhouette double, chosen boolean")


def choose_k(
    vectors: DataFrame, key: str = "customer_id", ks=range(4, 8), eligible=range(4, 8), seed: int = 42, restarts: int = 10
) -> Sweep:
    """Fit every k and choose the highest Euclidean silhouette of all rows among the eligible, the smallest k on ties.

    The silhouettes are refined until no other eligible k can be higher; the values of the sweep
    are exact where there are few different rows, and else within the bounds that settled the choice.
    """
    spark = tune(vectors.sparkSession)
    width = vectors.select(F.size(vector_to_array("features"))).head(1)
    features = [f"x{i}" for i in range(width[0][0] if width else 0)]
    flat = vectors.withColumn("_v", vector_to_array("features")).select(key, *[F.col("_v")[i].alias(f) for i, f in enumerate(features)])
    with Staging(spark, "sweep") as work:
        points = work.table(flat, "features")
        models = fit_kmeans(points, key, features, ks, seed, restarts)
        placed = points
        for k, model in models.items():
            placed = nearest_center(placed, [list(c) for c in model.clusterCenters()], features).withColumnRenamed("cluster", f"k{k}").drop("gap")
        names = [f"k{k}" for k in models if k in eligible]
        found = silhouette_bounds(
            placed, features, [f"k{k}" for k in models], work, lambda bounds: choice_is_certain(bounds, names)
        )
    scores = {k: found[f"k{k}"].value for k in models}
    ranked = [k for k in sorted(models) if k in eligible and scores[k] is not None]
    best = max(ranked, key=lambda k: (scores[k], -k))
    return Sweep(models, {k: m.inertia for k, m in models.items()}, scores, best)


def profile_clusters(rfm: DataFrame, by: str = "cluster") -> DataFrame:
    return rfm.groupBy(by).agg(*[mean(c).alias(c) for c in SEGMENT_FEATURES])


def label_segments(profile: DataFrame) -> DataFrame:
    """(cluster, segment): a name from how each cluster ranks among the clusters.

    One row per cluster comes in, so the windows are over a handful of rows.
    """
    def rank(order):
        return F.row_number().over(Window.orderBy(order, "cluster"))

    k = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = profile.select(
        "cluster",
        rank(F.asc("recency_days")).alias("r"), rank(F.desc("frequency")).alias("f"), rank(F.desc("monetary")).alias("m"),
        F.greatest(F.lit(1), F.bround(k / F.lit(3.0))).alias("third"),
        F.greatest(F.lit(1), F.bround(k / F.lit(2.0))).alias("half"),
    )
    r, f, m, third, half = (F.col(c) for c in ("r", "f", "m", "third", "half"))
    name = (
        F.when((r <= third) & (f <= third) & (m <= third), "Champions")
        .when((r <= half) & (f <= half), "Loyal Customers")
        .when((r <= third) & (f > half), "New Customers")
        .when(r <= half, "Potential Loyalists")
        .when((f <= half) | (m <= half), "At Risk")
        .otherwise("Hibernating")
    )
    return ranked.select("cluster", name.alias("segment"))


def nearest_center(df: DataFrame, centers: list[list[float]], cols: list[str]) -> DataFrame:
    """Add `cluster`, the number of the nearest centre (the first on ties), and `gap`, its squared distance."""
    gaps = F.array(*[
        reduce(add, [(F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(cols, center, strict=True)]) for center in centers
    ])
    return df.withColumn("_gaps", gaps).withColumns({
        "gap": F.array_min("_gaps"), "cluster": (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int"),
    }).drop("_gaps")


def inertia(placed: DataFrame) -> DataFrame:
    """The sum of squared distances of the rows of `nearest_center`."""
    return placed.agg(F.sum("gap").alias("inertia"))


def first_best(sweep: DataFrame) -> DataFrame:
    """The k of the highest silhouette, the smallest on ties; rows without a silhouette take no part."""
    known = sweep.where(F.col("silhouette").isNotNull())
    return known.agg(F.min_by("k", F.struct(-F.col("silhouette"), "k")).alias("k"), F.max("silhouette").alias("silhouette"))


def assign_segments(vectors: DataFrame, model: Model) -> DataFrame:
    """Customers of `prepare_features` with their cluster and its name."""
    centers = [list(c) for c in model.clusterCenters()]
    rows = nearest_center(vectors, centers, [f"{c}_z" for c in SEGMENT_FEATURES])
    # k rows at most
    names = F.broadcast(label_segments(profile_clusters(rows)))
    return rows.join(names, "cluster").select("customer_id", *SEGMENT_FEATURES, "cluster", "segment")


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment")


def segment_profile(segments: DataFrame) -> DataFrame:
    """Means per segment scaled to 0..1 over the segments."""
    means = profile_clusters(segments, "segment")
    whole = Window.partitionBy()

    def scaled(c: str):
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        return ((F.col(c) - low) / (high - low + F.lit(1e-9))).alias(c)

    return means.select("segment", *[scaled(c) for c in SEGMENT_FEATURES])


def run_segmentation(rfm: DataFrame, seed: int = 42, restarts: int = 10) -> tuple[DataFrame, Sweep]:
    """Scale, choose k, name the clusters: the segments and the sweep behind them."""
    vectors, _ = prepare_features(rfm)
    sweep = choose_k(vectors, seed=seed, restarts=restarts)
    return assign_segments(vectors, sweep.models[sweep.best_k]), sweep

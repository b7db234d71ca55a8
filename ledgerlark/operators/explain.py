"""Why a customer scores as they do: exact path-dependent SHAP values for the forest.

The trees have a fixed size (trees x 2^depth nodes), so their leaf paths travel to every task;
the rows stay where they are. Within a task numpy evaluates a batch of rows against all paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.functions.numeric import quotient
from ledgerlark.operators.ranking import top_k
from ledgerlark.session import staging_path


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted forest as a table, read back from its saved form."""
    path = staging_path(spark, "forest")
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.aggregate(stats, F.lit(0.0), lambda a, x: a + x).alias("cover"),
        F.try_divide(stats[1], F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("value"),
    )


def leaf_paths(nodes: pd.DataFrame) -> tuple[dict[int, tuple], float]:
    """Leaves by number of distinct features on their path, and the forest's mean output.

    Per group: feature, lower and upper bound and share of the cover per path feature
    (leaves x features), and the leaf's output divided by the number of trees.
    """
    trees = nodes["tree"].nunique()
    groups: dict[int, list] = {}
    base = 0.0
    for _, tree in nodes.groupby("tree"):
        rows = {r.node: r for r in tree.itertuples()}
        todo = [(0, {}, 1.0)]
        while todo:
            at, seen, reach = todo.pop()
            row = rows[at]
            if row.left < 0:
                base += reach * row.value / trees
                if seen:
                    groups.setdefault(len(seen), []).append((seen, row.value / trees))
                continue
            for child, low, high in ((row.left, -np.inf, row.threshold), (row.right, row.threshold, np.inf)):
                share = rows[child].cover / row.cover
                old = seen.get(row.feature, (-np.inf, np.inf, 1.0))
                bound = (max(old[0], low), min(old[1], high), old[2] * share)
                todo.append((child, {**seen, row.feature: bound}, reach * share))
    packed = {}
    for size, leaves in groups.items():
        packed[size] = (
            np.array([list(seen) for seen, _ in leaves]),
            *[np.array([[b[i] for b in seen.values()] for seen, _ in leaves]) for i in range(3)],
            np.array([value for _, value in leaves]),
        )
    return packed, base


def _coalition_weights(size: int) -> np.ndarray:
    """Shapley weight s! (size - s - 1)! / size! for each coalition size s."""
    weights = np.empty(size)
    weights[0] = 1.0 / size
    for s in range(1, size):
        weights[s] = weights[s - 1] * s / (size - s)
    return weights


#: Leaves taken at a time, so that a batch needs a few MB however large the forest is.
LEAVES = 1024
#: Rows explained at a time, and the longest paths whose contributions are tabled (for all 2^size ways to pass them).
ROWS, TABLED = 10_240, 10


def path_contributions(x: np.ndarray, packed: dict[int, tuple]) -> np.ndarray:
    """SHAP values (rows x features) of a batch.

    What a path gives depends only on which of its features pass, so the contributions of each such set
    are tabled and the rows look them up.
    """
    phi = np.zeros((x.shape[1], len(x)))
    for size, parts in packed.items():
        tabled = size <= TABLED and (parts[3] > 0).all()
        add, step = (_add_tabled, max(1, LEAVES >> size // 2)) if tabled else (_add_by_rows, LEAVES)
        for first in range(0, len(parts[0]), step):
            add(x, phi, *[part[first : first + step] for part in parts])
    return phi.T


def contribution_tables(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """SHAP values (features x leaves x sets) of some leaves; bit j of a set's number says that feature j passes.

    Feature j gives (o - z) times the integral over t in 0..1 of the product over the others of
    t o + (1 - t) z, where o is 1 if a feature passes, else 0, and z its cover share. The integrand is a
    polynomial of degree size - 1, for which (size + 1) // 2 points of Gauss and Legendre are exact.
    """
    leaves, size = share.shape
    out = np.zeros((size, leaves, 1 << size))
    split = [(slice(None), slice(None), bit) for bit in (0, 1)]
    shapes = [(leaves, -1, 2, 1 << j) for j in range(size)]
    for point, weight in zip(*np.polynomial.legendre.leggauss((size + 1) // 2), strict=True):
        t = (point + 1) / 2
        factors = (1 - t) * share, (1 - t) * share + t
        product = np.full((leaves, 1), weight / 2)
        for j in range(size):
            product = np.concatenate([product * f[:, j, None] for f in factors], axis=1)
        for j, shape in enumerate(shapes):
            for bit, f in zip(split, factors, strict=True):
                out[j].reshape(shape)[bit] += product.reshape(shape)[bit] / f[:, j, None, None]
    for j, shape in enumerate(shapes):
        for bit, passed in zip(split, (0.0, 1.0), strict=True):
            out[j].reshape(shape)[bit] *= ((passed - share[:, j]) * value)[:, None, None]
    return out


def _add_tabled(x: np.ndarray, phi: np.ndarray, feature: np.ndarray, low: np.ndarray, high: np.ndarray, share: np.ndarray, value: np.ndarray) -> None:
    """Add to `phi` (features x rows) what some leaves of one size give, from tables."""
    tables = contribution_tables(share, value)
    x, size = x.T, feature.shape[1]
    # Each bound is compared with the rows once for all leaves of the block that have it.
    sides = []
    for bound, passes in ((low, np.greater), (high, np.less_equal)):
        pairs, place = np.unique(np.column_stack([feature.reshape(-1), bound.reshape(-1)]), axis=0, return_inverse=True)
        sides.append((np.array([passes(x[int(f)], b) for f, b in pairs]), place.reshape(feature.shape)))
    (above, lower), (below, upper) = sides
    kind = np.uint8 if size <= 8 else np.uint16
    found, both, met, place = (np.empty(x.shape[1], k) for k in (np.float64, kind, kind, np.intp))
    above, below = above.astype(kind), below.astype(kind)
    for leaf in range(len(feature)):
        met[:] = 0
        for j in range(size):
            np.bitwise_and(above[lower[leaf, j]], below[upper[leaf, j]], out=both)
            np.left_shift(both, kind(j), out=both)
            np.bitwise_or(met, both, out=met)
        place[:] = met
        for j in range(size):
            np.take(tables[j, leaf], place, out=found, mode="clip")
            phi[feature[leaf, j]] += found


def _add_by_rows(x: np.ndarray, phi: np.ndarray, feature: np.ndarray, low: np.ndarray, high: np.ndarray, share: np.ndarray, value: np.ndarray) -> None:
    """As `_add_tabled`, for long paths: row by row.

    On one path, feature j passes (o=1) or not (o=0) and otherwise keeps its cover share z.
    The coefficients of the polynomial prod(z + o t) sum over the coalitions of all features;
    dividing one factor out leaves those without feature j, whose weighted sum is its value:
    -sum(p w) where it fails, and (1 - z) sum(q w) with q = p / (z + t) where it passes.
    """
    size = feature.shape[1]
    weights = _coalition_weights(size)
    for start in range(0, len(x), 64):
        part = x[start : start + 64]
        passes = [(part[:, f] > lo) & (part[:, f] <= hi) for f, lo, hi in zip(feature.T, low.T, high.T, strict=True)]
        poly = np.zeros((size + 1, len(part), len(value)))
        poly[0] = 1.0
        for degree in range(size):
            grown = poly[: degree + 1] * passes[degree]
            poly[: degree + 2] *= share[:, degree]
            poly[1 : degree + 2] += grown
        failed = -np.tensordot(weights, poly[:size], axes=1)
        for j in range(size):
            z = share[:, j]
            rest = poly[size].copy()
            total = weights[size - 1] * rest
            for s in range(size - 2, -1, -1):
                rest = poly[s + 1] - z * rest
                total += weights[s] * rest
            gain = np.where(passes[j], (1 - z) * total, failed) * value
            phi[:, start : start + 64] += (gain @ (feature[:, j, None] == np.arange(x.shape[1])).astype(float)).T


def forest_shap(model, rows: DataFrame, cols: list[str], key: str = "customer_id", batch: int = ROWS) -> tuple[DataFrame, float]:
    """Long table (key, feature, feature_value, phi) for class 1, and the base value.

    For every row the base value plus its phi add up to the forest's probability.
    """
    # Bounded by the forest's settings, not by the data.
    return shap_of_nodes(tree_nodes(rows.sparkSession, model).toPandas(), rows, cols, key, batch)


def shap_of_nodes(
    nodes: pd.DataFrame, rows: DataFrame, cols: list[str], key: str = "customer_id", batch: int = ROWS
) -> tuple[DataFrame, float]:
    """`forest_shap` for trees given as the table of `tree_nodes`."""
    spark = rows.sparkSession
    packed, base = leaf_paths(nodes)
    shared = spark.sparkContext.broadcast(packed)
    out = [f"phi_{c}" for c in cols]

    def explain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                x = np.stack(part["x"].to_numpy())
                phi = pd.DataFrame(path_contributions(x, shared.value), columns=out)
                yield pd.concat([part[[key]].reset_index(drop=True), pd.DataFrame(x, columns=cols), phi], axis=1)

    kind = rows.schema[key].dataType.simpleString()
    fields = ", ".join([f"`{key}` {kind}", *[f"`{c}` double" for c in [*cols, *out]]])
    # The work per row is large, so even a small table is spread over all cores.
    spread = rows.select(key, vector_to_array("features").alias("x")).repartition(spark.sparkContext.defaultParallelism, key)
    wide = spread.mapInPandas(explain, fields)
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("feature_value"), F.col(f"phi_{c}").alias("phi")) for c in cols
    ])).alias("cell")
    return wide.select(key, cells).select(key, "cell.*"), base


def global_importance(phi: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return phi.groupBy("feature").agg(
        quotient(F.sum(F.abs("phi")), F.count("phi")).alias("mean_abs_shap")
    ).orderBy(F.desc("mean_abs_shap"), "feature")


def top_drivers(importance: DataFrame, n: int = 10) -> DataFrame:
    return top_k(importance, [F.desc("mean_abs_shap"), "feature"], n)


def highest_risk(predictions: DataFrame, key: str = "customer_id") -> DataFrame:
    """The key with the highest probability, smallest key on ties."""
    return predictions.agg(F.min_by(key, F.struct(-F.col("churn_probability"), F.col(key))).alias(key))


def local_explanation(phi: DataFrame, predictions: DataFrame, base: float, n: int = 10, key: str = "customer_id") -> DataFrame:
    """The largest contributions for the customer at highest risk."""
    chosen = highest_risk(predictions, key).scalar()
    one = phi.where(F.col(key) == chosen).withColumn("base_value", F.lit(base))
    return top_k(one, [F.desc(F.abs("phi")), "feature"], n)


def linear_coefficients(spark: SparkSession, logistic, cols: list[str]) -> DataFrame:
    """(feature, coefficient) of the scaled logistic regression, smallest first."""
    weights = logistic.stages[-1].coefficients
    rows = [(c, float(w)) for c, w in zip(cols, weights, strict=True)]
    return spark.createDataFrame(rows, "feature string, coefficient double").orderBy("coefficient")


def linear_contributions(logistic, scaled: DataFrame, cols: list[str], key: str = "customer_id") -> DataFrame:
    """(key, feature, phi) of a linear model on scaled columns: weight times distance from the mean."""
    return weighted_distances(dict(zip(cols, logistic.stages[-1].coefficients, strict=True)), scaled, key)


def weighted_distances(weights: dict[str, float], scaled: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, feature, phi): each weight times its scaled column, whose mean is 0."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(f"{c}_z") * float(w)).alias("phi"))
        for c, w in weights.items()
    ])).alias("cell")
    return scaled.select(key, cells).select(key, "cell.*")

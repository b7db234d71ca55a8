"""Operators on models, checked from inputs that SQL has too: given centres, weights, trees and predictions.

Rows about the trained models themselves state what must hold for any training, beside what SQL
knows of the same rows: how many there are, their spread, or their keys.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks.catalog import add
from checks.models import AUC, PROFILE, TP, Z_POINTS, _z
from checks.oracle import div, r6
from checks.tables import rounded
from ledgerlark import schemas
from ledgerlark.operators import churn, explain, metrics, segments
from ledgerlark.operators.churn import CHURN_FEATURE_COLUMNS
from ledgerlark.operators.segments import SEGMENT_FEATURES

SCALED = [f"{c}_z" for c in SEGMENT_FEATURES]


# --- G and T: given centres, the means of the given clusters ---


def _placed(t):
    vectors, _ = segments.prepare_features(t.segments)
    centers = vectors.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in SCALED]).orderBy("cluster").collect()
    return segments.nearest_center(vectors.drop("cluster"), [[r[c] for c in SCALED] for r in centers], SCALED)


PLACED = f"""(WITH points AS (SELECT customer_id, cluster, {Z_POINTS} FROM segs),
    centers AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY cluster) - 1 AS INTEGER) AS i, AVG(z0) AS c0, AVG(z1) AS c1, AVG(z2) AS c2 FROM points GROUP BY cluster)
    SELECT customer_id, ARG_MIN(i, ROW(gap, i)) AS cluster, MIN(gap) AS gap FROM
        (SELECT customer_id, i, (z0 - c0) * (z0 - c0) + (z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2) AS gap FROM points, centers) GROUP BY customer_id)"""

add("g08_given_centers", lambda t: _placed(t).select("customer_id", "cluster"), f"SELECT customer_id, cluster FROM {PLACED}")
add("g03_given_inertia", lambda t: rounded(segments.inertia(_placed(t)), "inertia", places=4),
    f"SELECT ROUND(SUM(gap), 4) AS inertia FROM {PLACED}")
add("t06_given_scores", lambda t: segments.first_best(segments.profile_clusters(t.segments).select(F.col("cluster").alias("k"), F.col("frequency").alias("silhouette"))),
    f"SELECT cluster AS k, frequency AS silhouette FROM {PROFILE} ORDER BY frequency DESC, cluster LIMIT 1")


def _moved_centers(t):
    """Customers placed, and clusters whose centre is not the mean of the customers nearest to it."""
    vectors, _ = segments.prepare_features(t.staged_rfm)
    centers = [list(c) for c in t.sweep.models[t.sweep.best_k].clusterCenters()]
    means = segments.nearest_center(vectors, centers, SCALED).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in SCALED])
    off = [F.abs(F.col(c) - F.get(F.array(*[F.lit(float(x[i])) for x in centers]), F.col("cluster"))) > 0.01 for i, c in enumerate(SCALED)]
    return means.agg(F.sum("n").alias("customers"), F.count_if(off[0] | off[1] | off[2]).alias("moved"))


def _sum_of(column: str, sql: str, name: str) -> str:
    return f"SELECT COUNT(*) AS customers, {sql} AS {name} FROM {column}"


add("g02_centers_are_means", _moved_centers, _sum_of("rfm", "0::BIGINT", "moved"))


def _choice(t):
    """Customers of the sweep, and eligible numbers of clusters that score higher than the chosen one."""
    sweep = t.sweep.table(t.spark)
    best = sweep.where("chosen").agg(F.max("silhouette")).scalar()
    better = sweep.where("k BETWEEN 4 AND 7").agg(F.count_if(F.col("silhouette") > best)).scalar()
    return t.staged_rfm.agg(F.count(F.lit(1)).alias("customers")).withColumn("better", better)


add("g05_choice_is_best", _choice, _sum_of("rfm", "0::BIGINT", "better"))


def _rising_inertia(t):
    """The spread of all customers, which is one cluster's inertia, and numbers of clusters that fit worse than one fewer."""
    vectors, _ = segments.prepare_features(t.staged_rfm)
    whole = vectors.agg(F.round(sum((F.sum(F.col(c) * F.col(c)) for c in SCALED), F.lit(0.0)), 4).alias("one_cluster"))
    sweep = t.sweep.table(t.spark).select("k", "inertia")
    fewer = sweep.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("before")).unionByName(
        whole.select(F.lit(2).alias("k"), F.col("one_cluster").alias("before")))
    rising = sweep.join(fewer, "k").agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("inertia") > 1.01 * F.col("before")).alias("rising"))
    return whole.withColumns({c: rising.select(c).scalar() for c in rising.columns})


add("n08_inertia_falls", _rising_inertia,
    f"SELECT ROUND(SUM(z0 * z0 + z1 * z1 + z2 * z2), 4) AS one_cluster, 7::BIGINT AS compared, 0::BIGINT AS rising FROM (SELECT {Z_POINTS} FROM segs)")

# --- M and N: two given sets of predictions, and rules for the trained ones ---


def _second(t):
    """The given predictions with every seventh customer turned over."""
    turned = F.col("customer_id") % 7 == 0
    return t.predictions.withColumns({
        "predicted_churned": F.when(turned, 1 - F.col("predicted_churned")).otherwise(F.col("predicted_churned")),
        "churn_probability": F.when(turned, F.bround(1 - F.col("churn_probability"), 4)).otherwise(F.col("churn_probability")),
    })


def _given_record(t):
    pair = [metrics.model_metrics(p, n, "churn_probability") for p, n in ((_second(t), churn.LOGISTIC), (t.predictions, churn.FOREST))]
    return churn.model_record(*pair, [0.91, 0.94, 0.9, 0.95, 0.93])


TURNED = """(SELECT * REPLACE (CASE WHEN customer_id % 7 = 0 THEN 1 - predicted_churned ELSE predicted_churned END AS predicted_churned,
             CASE WHEN customer_id % 7 = 0 THEN 10000 - p10k ELSE p10k END AS p10k) FROM preds)"""


def _metrics_sql(model: str, view: str) -> str:
    area = AUC.replace("FROM preds", f"FROM {view} w")
    return f"""SELECT '{model}' AS model, ROUND({div(TP, 'SUM(predicted_churned)')}, 3) AS precision, ROUND({div(TP, 'SUM(actual_churned)')}, 3) AS recall,
        ROUND({div(f'2 * {TP}', 'SUM(predicted_churned) + SUM(actual_churned)')}, 3) AS f1_score, ROUND({area}, 3) AS roc_auc FROM {view} v"""


BOTH = f"{_metrics_sql(churn.LOGISTIC, TURNED)} UNION ALL {_metrics_sql(churn.FOREST, 'preds')}"

add("n09_given_comparison", lambda t: churn.comparison_table(t.spark, _given_record(t)), BOTH)
add("m12_given_best", lambda t: churn.comparison_table(t.spark, _given_record(t)).where(F.col("model") == _given_record(t)["best_model"]),
    f"SELECT * FROM ({BOTH}) ORDER BY roc_auc DESC, model DESC LIMIT 1")
add("m13_given_record", lambda t: t.spark.createDataFrame([_given_record(t)], schemas.MODEL_RECORD).select(
        "best_model", "random_forest_cv_roc_auc_mean", "random_forest_cv_roc_auc_std", F.size("churn_feature_columns").alias("features"),
        F.col("random_forest.roc_auc").alias("forest_area")),
    f"""SELECT ARG_MAX(model, ROW(roc_auc, model)) AS best_model, 0.926::DOUBLE AS random_forest_cv_roc_auc_mean, 0.019::DOUBLE AS random_forest_cv_roc_auc_std,
        CAST(13 AS INTEGER) AS features, MAX(CASE WHEN model = '{churn.FOREST}' THEN roc_auc END) AS forest_area FROM ({BOTH})""")
add("m14_given_scores", lambda t: churn.predictions_table(t.predictions.withColumn("score", (F.col("customer_id") * 37 % 10007) / F.lit(16384.0))),
    "SELECT customer_id, actual_churned, predicted_churned, ROUND_EVEN((customer_id * 37 % 10007) / 16384.0::DOUBLE, 4) AS churn_probability FROM preds")
add("m06_every_test_row_scored", lambda t: t.churn_run.test_scores[churn.FOREST].select(
        "customer_id", "actual_churned", (F.col("score").between(0, 1) & (F.col("predicted_churned") == (F.col("score") > 0.5).cast("int"))).alias("sound")),
    "SELECT customer_id, CAST(churned AS INTEGER) AS actual_churned, TRUE AS sound FROM split WHERE is_test")
add("m07_every_fold_scored", lambda t: t.churn_run.folds.join(
        churn.stratified_folds(t.churnset).groupBy("fold").agg(F.count(F.lit(1)).alias("rows")), "fold"
    ).select("fold", "rows", F.col("roc_auc").between(0, 1).alias("sound")),
    "SELECT CAST((place - 1) % 5 AS INTEGER) AS fold, COUNT(*) AS rows, TRUE AS sound FROM dealt GROUP BY 1")


def _gradient(t):
    """The gradient of the logistic objective at the solution, rounded: 0 for every weight."""
    run = t.churn_run
    train = churn.with_weights(run.split.where(~F.col("is_test")).drop("features"))
    model = run.logistic.stages[-1]
    rows = run.scaler.apply(train)
    margin = sum((F.col(f"{c}_z") * float(w) for c, w in zip(CHURN_FEATURE_COLUMNS, model.coefficients, strict=True)), F.lit(float(model.intercept)))
    off = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("churned"))
    n = F.count(F.lit(1))
    parts = rows.agg(*[(F.sum(off * F.col(f"{c}_z")) / n + float(w) / n).alias(c) for c, w in zip(CHURN_FEATURE_COLUMNS, model.coefficients, strict=True)],
                     (F.sum(off) / n).alias("intercept"))
    names = [*CHURN_FEATURE_COLUMNS, "intercept"]
    return parts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), (F.abs(F.col(c)) < 0.001).alias("flat")) for c in names])))


add("m05_gradient_is_flat", _gradient,
    " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS flat" for c in [*CHURN_FEATURE_COLUMNS, "intercept"]))

# --- E: given weights and given trees ---

WEIGHTS = {"recency_days": 0.25, "frequency": -0.5, "monetary": 0.125}


def _given_linear(t):
    vectors, _ = segments.prepare_features(t.rfm)
    return rounded(explain.weighted_distances(WEIGHTS, vectors), "phi")


add("e05_given_weights", _given_linear, " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, {r6(f'{_z(c, 'rfm')} * {w}')} AS phi FROM rfm" for c, w in WEIGHTS.items()))

#: Tree 0 splits on recency and then on frequency, tree 1 on money spent; covers are rows.
NODES = pd.DataFrame(
    [
        (0, 0, 1, 2, 0, 200.0, 100.0, None), (0, 1, 3, 4, 1, 5.0, 60.0, None), (0, 2, 5, 6, 1, 10.0, 40.0, None),
        (0, 3, -1, -1, -1, None, 20.0, 0.5), (0, 4, -1, -1, -1, None, 40.0, 0.1), (0, 5, -1, -1, -1, None, 30.0, 0.9), (0, 6, -1, -1, -1, None, 10.0, 0.6),
        (1, 0, 1, 2, 2, 2000000.0, 100.0, None), (1, 1, -1, -1, -1, None, 50.0, 0.7), (1, 2, -1, -1, -1, None, 50.0, 0.2),
    ],
    columns=["tree", "node", "left", "right", "feature", "threshold", "cover", "value"],
)


def _given_forest(t):
    doubles = t.rfm.select("customer_id", *[F.col(c).cast("double").alias(c) for c in SEGMENT_FEATURES])
    rows = VectorAssembler(inputCols=SEGMENT_FEATURES, outputCol="features").transform(doubles)
    phi, _ = explain.shap_of_nodes(NODES, rows, SEGMENT_FEATURES)
    return rounded(phi.select("customer_id", "feature", "phi"), "phi")


_LOW = "(CASE WHEN frequency <= 5 THEN 0.5 ELSE 0.1 END)"
_HIGH = "(CASE WHEN frequency <= 10 THEN 0.9 ELSE 0.6 END)"
_MEANS = "(20 * 0.5 + 40 * 0.1) / 60.0::DOUBLE", "(30 * 0.9 + 10 * 0.6) / 40.0::DOUBLE"
add("e01_given_trees", _given_forest, f"""
    WITH worth AS (SELECT customer_id, monetary, 0.6 * {_MEANS[0]} + 0.4 * {_MEANS[1]} AS none,
        CASE WHEN recency_days <= 200 THEN {_MEANS[0]} ELSE {_MEANS[1]} END AS r, 0.6::DOUBLE * {_LOW} + 0.4::DOUBLE * {_HIGH} AS f,
        CAST(CASE WHEN recency_days <= 200 THEN {_LOW} ELSE {_HIGH} END AS DOUBLE) AS whole FROM rfm)
    SELECT customer_id, 'recency_days' AS feature, {r6('((r - none) + (whole - f)) / 4')} AS phi FROM worth
    UNION ALL SELECT customer_id, 'frequency', {r6('((f - none) + (whole - r)) / 4')} FROM worth
    UNION ALL SELECT customer_id, 'monetary', {r6('(CASE WHEN monetary <= 2000000 THEN 0.7 ELSE 0.2 END - 0.45::DOUBLE) / 2')} FROM worth""".replace("WITH worth AS (", "SELECT * FROM (WITH worth AS (", 1) + ")")


def _balanced(t):
    """Test customers, and whether their contributions and the base add up to the forest's score."""
    phi, base = t.shap
    total = phi.groupBy("customer_id").agg((F.sum("phi") + base).alias("total"))
    return t.churn_run.test_scores[churn.FOREST].join(total, "customer_id", "left").select(
        "customer_id", F.coalesce(F.abs(F.col("score") - F.col("total")) <= 1e-9, F.lit(False)).alias("balanced"))


add("e01_contributions_add_up", _balanced, "SELECT customer_id, TRUE AS balanced FROM split WHERE is_test")

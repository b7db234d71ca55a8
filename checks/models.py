"""Checks of segmentation, churn models and explanation (G, M, E and the rows that use them).

Rows that need a trained model have no SQL; what can be computed from given labels or given
predictions has.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.catalog import add
from checks.oracle import dbl, div, int_, r6
from checks.tables import plain, rounded
from ledgerlark.operators import churn, explain, kmeans, metrics, segments, silhouettes
from ledgerlark.operators.churn import CHURN_FEATURE_COLUMNS
from ledgerlark.operators.segments import SEGMENT_FEATURES
from ledgerlark.session import Staging, staging_path

# --- G: segmentation ---


def _z(c: str, view: str) -> str:
    return f"(CAST({c} AS DOUBLE) - (SELECT AVG(CAST({c} AS DOUBLE)) FROM {view})) / (SELECT STDDEV_POP(CAST({c} AS DOUBLE)) FROM {view})"


def _scaled(t):
    vectors, _ = segments.prepare_features(t.rfm)
    return rounded(vectors.select("customer_id", *[f"{c}_z" for c in SEGMENT_FEATURES]), *[f"{c}_z" for c in SEGMENT_FEATURES])


def _given_silhouette(t):
    vectors, _ = segments.prepare_features(t.segments)
    found = segments.squared_silhouette(vectors, [f"{c}_z" for c in SEGMENT_FEATURES], ["cluster"])
    return rounded(found, "silhouette")


Z_POINTS = ", ".join(f"{_z(c, 'segs')} AS z{i}" for i, c in enumerate(SEGMENT_FEATURES))
SILHOUETTE_SQL = f"""SELECT * FROM (
    WITH points AS (SELECT customer_id, cluster, {Z_POINTS} FROM segs),
    sums AS (SELECT cluster AS other, COUNT(*) AS n, SUM(z0) AS s0, SUM(z1) AS s1, SUM(z2) AS s2, SUM(z0 * z0 + z1 * z1 + z2 * z2) AS q FROM points GROUP BY 1),
    gaps AS (SELECT customer_id, MAX(CASE WHEN cluster = other THEN n END) AS size,
                    MAX(CASE WHEN cluster = other THEN total / GREATEST(n - 1, 1) END) AS inner_gap, MIN(CASE WHEN cluster <> other THEN total / n END) AS outer_gap
             FROM (SELECT customer_id, cluster, other, n, n * (z0 * z0 + z1 * z1 + z2 * z2) - 2 * (z0 * s0 + z1 * s1 + z2 * s2) + q AS total FROM points, sums)
             GROUP BY customer_id)
    SELECT 'cluster' AS labels, {r6('AVG(CASE WHEN size = 1 THEN 0 ELSE (outer_gap - inner_gap) / GREATEST(inner_gap, outer_gap) END)')} AS silhouette FROM gaps)"""
PROFILE = f"""(SELECT cluster, {div('SUM(recency_days)', 'COUNT(*)')} AS recency_days, {div('SUM(frequency)', 'COUNT(*)')} AS frequency,
               {div('SUM(monetary)', 'COUNT(*)')} AS monetary FROM segs GROUP BY cluster)"""
LABELLED = f"""(SELECT customer_id, {Z_POINTS}, cluster, CASE WHEN recency_days <= 180 THEN 0 ELSE 1 END AS recent,
    CASE WHEN frequency > 10 THEN 0 WHEN frequency > 5 THEN 1 ELSE 2 END AS often FROM segs)"""


def _euclidean_sql(column: str) -> str:
    """The formula, row by row against row."""
    return f"""SELECT '{column}' AS labels, {r6('AVG(CASE WHEN inner_gap IS NULL OR GREATEST(inner_gap, outer_gap) = 0 THEN 0 ELSE (outer_gap - inner_gap) / GREATEST(inner_gap, outer_gap) END)')} AS silhouette FROM (
        SELECT id, MAX(CASE WHEN own = other THEN total / NULLIF(n - 1, 0) END) AS inner_gap, MIN(CASE WHEN own <> other THEN total / n END) AS outer_gap FROM (
            SELECT a.customer_id AS id, a.{column} AS own, b.{column} AS other, COUNT(*) AS n,
                   SUM(SQRT((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2))) AS total
            FROM {LABELLED} a, {LABELLED} b GROUP BY 1, 2, 3) GROUP BY id)"""


def _labelled(t):
    r, f = F.col("recency_days"), F.col("frequency")
    vectors, _ = segments.prepare_features(t.segments)
    return vectors.withColumns({
        "recent": F.when(r <= 180, 0).otherwise(1), "often": F.when(f > 10, 0).when(f > 5, 1).otherwise(2),
    })


LABELS = ["cluster", "recent", "often"]
SCALED = [f"{c}_z" for c in SEGMENT_FEATURES]


def _euclidean(t):
    return rounded(silhouettes.euclidean_silhouette(_labelled(t), SCALED, LABELS, Staging(t.spark, "silhouettes")), "silhouette")


def _chosen_labels(t):
    return rounded(silhouettes.choose_labels(_labelled(t), SCALED, LABELS, Staging(t.spark, "silhouettes")), "silhouette")


BY_SEGMENT = PROFILE.replace("cluster", "segment")


def _centers(t):
    model = t.sweep.models[t.sweep.best_k]
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return t.spark.createDataFrame(rows, "cluster int, recency_z double, frequency_z double, monetary_z double")


add("g01_scaling", _scaled, "SELECT customer_id, " + ", ".join(f"{r6(_z(c, 'rfm'))} AS {c}_z" for c in SEGMENT_FEATURES) + " FROM rfm")
add("g02_kmeans_centers", _centers)
def _one_step(t):
    """Where one pass moves the centres of two given models at once."""
    rows = _labelled(t)
    means = {c: rows.groupBy(c).agg(*[F.avg(z).alias(z) for z in SCALED]).orderBy(c).collect() for c in ("cluster", "often")}
    points = rows.select(*SCALED, F.xxhash64("customer_id").alias("h"))
    found = kmeans.cluster_sums(points, [np.array([[r[z] for z in SCALED] for r in own]) for own in means.values()])
    moved = [(F.col(f"s{i}") / F.col("n")).alias(f"c{i}") for i in range(len(SCALED))]
    return rounded(found.select("model", "cluster", "n", "cost", *moved), "cost", *[f"c{i}" for i in range(len(SCALED))])


def _one_step_sql(number: int, column: str) -> str:
    centers = f"""(SELECT CAST(ROW_NUMBER() OVER (ORDER BY {column}) - 1 AS INTEGER) AS i, AVG(z0) AS c0, AVG(z1) AS c1, AVG(z2) AS c2
                   FROM {LABELLED} GROUP BY {column})"""
    gap = "(z0 - c0) * (z0 - c0) + (z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2)"
    near = f"(SELECT customer_id, ARG_MIN(i, ROW({gap}, i)) AS cluster, MIN({gap}) AS gap, MAX(z0) AS z0, MAX(z1) AS z1, MAX(z2) AS z2 FROM {LABELLED} p, {centers} c GROUP BY customer_id)"
    return f"""SELECT CAST({number} AS INTEGER) AS model, cluster, COUNT(*) AS n, {r6('SUM(gap)')} AS cost, {r6('AVG(z0)')} AS c0, {r6('AVG(z1)')} AS c1, {r6('AVG(z2)')} AS c2
               FROM {near} GROUP BY cluster"""


add("g02_given_step", _one_step, " UNION ALL ".join(_one_step_sql(i, c) for i, c in enumerate(("cluster", "often"))))
add("g03_inertia", lambda t: t.sweep.table(t.spark).select("k", "inertia"))
add("g04_silhouette", _given_silhouette, SILHOUETTE_SQL)
add("g04_euclidean_silhouette", _euclidean, " UNION ALL ".join(_euclidean_sql(c) for c in LABELS))
add("g05_given_labels", _chosen_labels, f"SELECT * FROM ({' UNION ALL '.join(_euclidean_sql(c) for c in LABELS)}) ORDER BY silhouette DESC, labels LIMIT 1")
add("g05_choose_k", lambda t: t.sweep.table(t.spark))
add("g06_cluster_profile", lambda t: segments.profile_clusters(t.segments), f"SELECT * FROM {PROFILE}")
add("g07_label_segments", lambda t: segments.label_segments(segments.profile_clusters(t.segments)),
    f"""SELECT cluster, CASE WHEN r <= a AND f <= a AND m <= a THEN 'Champions' WHEN r <= b AND f <= b THEN 'Loyal Customers'
        WHEN r <= a AND f > b THEN 'New Customers' WHEN r <= b THEN 'Potential Loyalists' WHEN f <= b OR m <= b THEN 'At Risk' ELSE 'Hibernating' END AS segment
        FROM (SELECT cluster, ROW_NUMBER() OVER (ORDER BY recency_days, cluster) AS r, ROW_NUMBER() OVER (ORDER BY frequency DESC, cluster) AS f,
              ROW_NUMBER() OVER (ORDER BY monetary DESC, cluster) AS m, GREATEST(1, ROUND_EVEN(COUNT(*) OVER () / 3.0::DOUBLE, 0)) AS a,
              GREATEST(1, ROUND_EVEN(COUNT(*) OVER () / 2.0::DOUBLE, 0)) AS b FROM {PROFILE})""")
add("g08_customer_segments", lambda t: plain(t.found_segments))
add("g09_segment_sizes", lambda t: segments.segment_sizes(t.segments), "SELECT segment, COUNT(*) AS customers FROM segs GROUP BY segment")
add("g09_segment_profile", lambda t: rounded(segments.segment_profile(t.segments), *SEGMENT_FEATURES),
    "SELECT segment, " + ", ".join(f"{r6(f'({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER () + 1e-9)')} AS {c}" for c in SEGMENT_FEATURES)
    + f" FROM {BY_SEGMENT}")
add("n08_k_sweep", lambda t: t.sweep.table(t.spark))
add("t06_first_best", lambda t: t.sweep.table(t.spark).where("chosen").select("k", "silhouette"))

# --- M: churn models ---


def _matrix(t):
    vector = vector_to_array("features")
    return churn.feature_matrix(t.churnset).select(
        "customer_id", *[vector[i].alias(c) for i, c in enumerate(CHURN_FEATURE_COLUMNS)]
    )


def _train_scaled(t):
    split = churn.stratified_split(t.churnset)
    cols = CHURN_FEATURE_COLUMNS
    scaler = segments.fit_scaler(split.where(~F.col("is_test")), cols)
    return rounded(scaler.apply(split).select("customer_id", *[f"{c}_z" for c in cols]), *[f"{c}_z" for c in cols])


TP = "COUNT(*) FILTER (actual_churned = 1 AND predicted_churned = 1)"
AUC = """(SELECT (SUM(CASE WHEN actual_churned = 1 THEN avg_rank END) - SUM(actual_churned) * (SUM(actual_churned) + 1) / 2.0::DOUBLE)
          / (CAST(SUM(actual_churned) AS DOUBLE) * SUM(1 - actual_churned))
          FROM (SELECT *, RANK() OVER (ORDER BY p10k) + (COUNT(*) OVER (PARTITION BY p10k) - 1) / 2.0::DOUBLE AS avg_rank FROM preds))"""


def _report_sql() -> str:
    per = ", ".join(
        f"""{div(f'COUNT(*) FILTER (a = {c} AND p = {c})', f'COUNT(*) FILTER (p = {c})')} AS pr{c}, {div(f'COUNT(*) FILTER (a = {c} AND p = {c})', f'COUNT(*) FILTER (a = {c})')} AS re{c},
            {div(f'2 * COUNT(*) FILTER (a = {c} AND p = {c})', f'COUNT(*) FILTER (p = {c}) + COUNT(*) FILTER (a = {c})')} AS f{c}, COUNT(*) FILTER (a = {c}) AS n{c}"""
        for c in (0, 1)
    )
    view = f"(SELECT {per}, {div('COUNT(*) FILTER (a = p)', 'COUNT(*)')} AS acc, COUNT(*) AS n FROM (SELECT actual_churned AS a, predicted_churned AS p FROM preds))"

    def line(name, a, b, c, n):
        return f"SELECT '{name}' AS class, {r6(a)} AS precision, {r6(b)} AS recall, {r6(c)} AS f1_score, {n} AS support FROM {view}"

    weighted = [f"({m}0 * n0 + {m}1 * n1) / n" for m in ("pr", "re", "f")]
    return " UNION ALL ".join([
        line("Not Churned", "pr0", "re0", "f0", "n0"), line("Churned", "pr1", "re1", "f1", "n1"), line("accuracy", "acc", "acc", "acc", "n"),
        line("macro avg", "(pr0 + pr1) / 2", "(re0 + re1) / 2", "(f0 + f1) / 2", "n"), line("weighted avg", *weighted, "n"),
    ])


QUALITY = ["precision", "recall", "f1_score"]

add("m01_feature_matrix", _matrix, "SELECT customer_id, " + ", ".join(f"{dbl(c)} AS {c}" for c in CHURN_FEATURE_COLUMNS) + " FROM churnset")
add("m02_stratified_split", lambda t: churn.stratified_split(t.churnset).select("customer_id", "churned", "is_test"), "SELECT customer_id, churned, is_test FROM split")
add("m03_train_scaling", _train_scaled,
    "SELECT customer_id, " + ", ".join(
        f"{r6(f'(CAST({c} AS DOUBLE) - (SELECT AVG(CAST({c} AS DOUBLE)) FROM split WHERE NOT is_test)) / (SELECT STDDEV_POP(CAST({c} AS DOUBLE)) FROM split WHERE NOT is_test)')} AS {c}_z"
        for c in CHURN_FEATURE_COLUMNS) + " FROM split")
add("m04_class_weights", lambda t: churn.class_weights(t.labels), f"SELECT churned, COUNT(*) AS rows, {div('(SELECT COUNT(*) FROM churnlab)', '2 * COUNT(*)')} AS weight FROM churnlab GROUP BY churned")
add("m05_logistic_regression", lambda t: explain.linear_coefficients(t.spark, t.churn_run.logistic, CHURN_FEATURE_COLUMNS))
add("m06_random_forest", lambda t: t.churn_run.test_scores[churn.FOREST])
add("m07_cross_validation", lambda t: t.churn_run.folds)
add("m07_folds", lambda t: churn.stratified_folds(t.churnset).select("customer_id", "churned", "fold"), f"SELECT customer_id, churned, {int_('(place - 1) % 5')} AS fold FROM dealt")
add("m08_precision_recall", lambda t: metrics.precision_recall_f1(t.predictions),
    f"SELECT {div(TP, 'SUM(predicted_churned)')} AS precision, {div(TP, 'SUM(actual_churned)')} AS recall, {div(f'2 * {TP}', 'SUM(predicted_churned) + SUM(actual_churned)')} AS f1_score FROM preds")
add("m09_roc_auc", lambda t: rounded(metrics.roc_auc(t.predictions), "roc_auc"), f"SELECT {r6(AUC)} AS roc_auc")
add("m10_classification_report", lambda t: rounded(metrics.classification_report(t.predictions), *QUALITY), _report_sql())
add("m11_confusion_matrix", lambda t: metrics.confusion_matrix(t.predictions),
    "SELECT actual_churned AS actual, COUNT(*) FILTER (predicted_churned = 0) AS predicted_0, COUNT(*) FILTER (predicted_churned = 1) AS predicted_1 FROM preds GROUP BY 1")
add("m12_best_model", lambda t: t.churn_run.metrics_table(t.spark).where(F.col("model") == t.churn_run.best_name))
add("m13_metrics_record", lambda t: t.churn_run.record_table(t.spark))
add("m14_scored_customers", lambda t: t.churn_run.predictions())
add("m15_train_summary", lambda t: churn.train_summary(churn.stratified_split(t.churnset).where(~F.col("is_test"))),
    f"SELECT COUNT(*) AS train_rows, {div('SUM(churned)', 'COUNT(*)')} AS churn_rate FROM split WHERE NOT is_test")
add("n09_model_comparison", lambda t: t.churn_run.metrics_table(t.spark))


def _persisted(t):
    """Test customers, and how many models score them on raw rows, saved and loaded again, as in training."""
    test = t.churn_run.split.where("is_test").drop("features")
    found = None
    for name, model in ((churn.LOGISTIC, t.churn_run.logistic), (churn.FOREST, churn.on_raw_rows(t.churn_run.forest))):
        path = staging_path(t.spark, "model")
        model.write().overwrite().save(path)
        again = churn.scored(PipelineModel.load(path), test).select("customer_id", F.col("score").alias("loaded"))
        both = t.churn_run.test_scores[name].join(again, "customer_id", "full")
        part = both.select("customer_id", F.col("score").eqNullSafe(F.col("loaded")).cast("int").alias("same"))
        found = part if found is None else found.union(part)
    return found.groupBy("customer_id").agg(F.sum("same").alias("same"))


add("s12_model_persistence", _persisted, "SELECT customer_id, 2::BIGINT AS same FROM split WHERE is_test")

# --- E: explanation ---


def _linear(t):
    scaled = t.churn_run.scaler.apply(t.churn_run.split.where("is_test").drop("features"))
    return explain.linear_contributions(t.churn_run.logistic, scaled, CHURN_FEATURE_COLUMNS)


def _forest_predictions(t):
    return churn.predictions_table(t.churn_run.test_scores[churn.FOREST])


add("e01_forest_shap", lambda t: t.shap[0])
add("e02_global_importance", lambda t: explain.global_importance(t.shap[0]))
add("e03_top_drivers", lambda t: explain.top_drivers(explain.global_importance(t.shap[0]), 10))
add("e04_local_explanation", lambda t: explain.local_explanation(t.shap[0], _forest_predictions(t), t.shap[1]))
add("e05_linear_coefficients", lambda t: explain.linear_coefficients(t.spark, t.churn_run.logistic, CHURN_FEATURE_COLUMNS))
add("e05_linear_contributions", _linear)


def _given_phi(t):
    """Contributions that SQL can state too: distances of two features from a fixed value."""
    parts = F.array(
        F.struct(F.lit("recency_days").alias("feature"), ((F.col("recency_days") - 200).cast("double") / 1000).alias("phi")),
        F.struct(F.lit("frequency").alias("feature"), ((8 - F.col("frequency")).cast("double") / 100).alias("phi")),
    )
    return t.rfm.select("customer_id", F.inline(parts))


GIVEN_PHI = """(SELECT customer_id, 'recency_days' AS feature, CAST(recency_days - 200 AS DOUBLE) / 1000 AS phi FROM rfm
                UNION ALL SELECT customer_id, 'frequency', CAST(8 - frequency AS DOUBLE) / 100 FROM rfm)"""
IMPORTANCE = f"SELECT feature, {r6('AVG(ABS(phi))')} AS mean_abs_shap FROM {GIVEN_PHI} GROUP BY feature"

add("e02_importance_of_given", lambda t: rounded(explain.global_importance(_given_phi(t)), "mean_abs_shap"), IMPORTANCE)
add("e03_top_of_given", lambda t: rounded(explain.top_drivers(explain.global_importance(_given_phi(t)), 1), "mean_abs_shap"),
    IMPORTANCE + " ORDER BY mean_abs_shap DESC LIMIT 1")
add("e04_local_of_given", lambda t: explain.local_explanation(_given_phi(t), t.predictions, 0.5),
    f"""SELECT customer_id, feature, phi, 0.5::DOUBLE AS base_value FROM {GIVEN_PHI}
        WHERE customer_id = (SELECT customer_id FROM preds ORDER BY churn_probability DESC, customer_id LIMIT 1)""")

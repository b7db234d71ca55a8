from itertools import combinations
from math import comb, factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlark.operators import churn, explain, metrics, segments

COLUMNS = ["a", "b", "c"]


def profile(spark, rows):
    return spark.createDataFrame([(i, float(r), float(f), float(m)) for i, (r, f, m) in enumerate(rows)], "cluster int, recency_days double, frequency double, monetary double")


@pytest.mark.parametrize("rows, want", [
    ([(5, 20, 5000), (300, 1, 50), (60, 8, 900), (10, 2, 150)], ["Champions", "Hibernating", "At Risk", "Potential Loyalists"]),
    ([(10, 15, 3000), (400, 0, 20), (200, 3, 300), (50, 6, 700), (15, 12, 2000), (500, 1, 40)],
     ["Champions", "Hibernating", "Hibernating", "Loyal Customers", "Champions", "Hibernating"]),
    ([(10, 10, 2000), (300, 1, 50)], ["Champions", "Hibernating"]),
])
def test_segment_names(spark, rows, want):
    got = {r.cluster: r.segment for r in segments.label_segments(profile(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_scaler_uses_population_deviation_and_zero_for_constants(spark):
    df = spark.createDataFrame([(1.0, 3), (3.0, 3), (None, 3)], "x double, y int")
    scaled = segments.fit_scaler(df, ["x", "y"]).apply(df).collect()
    x = np.array([1.0, 3.0, 0.0])
    assert [r.x_z for r in scaled] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert {r.y_z for r in scaled} == {0.0}


def test_silhouette_by_hand(spark):
    points = [(0.0, 0, 0), (1.0, 0, 0), (5.0, 1, 0), (6.5, 1, 0), (20.0, 2, 0)]
    df = spark.createDataFrame(points, "x double, l int, one int")
    got = {r.labels: r.silhouette for r in segments.squared_silhouette(df, ["x"], ["l", "one"]).collect()}
    xs, ls = [p[0] for p in points], [p[1] for p in points]
    each = []
    for i, x in enumerate(xs):
        def mean(label, skip):
            return np.mean([(x - y) ** 2 for j, y in enumerate(xs) if ls[j] == label and j != skip])
        if ls.count(ls[i]) == 1:
            each.append(0.0)
            continue
        a, b = mean(ls[i], i), min(mean(label, None) for label in set(ls) - {ls[i]})
        each.append((b - a) / max(a, b))
    assert got["l"] == pytest.approx(np.mean(each)) and got["one"] is None


def test_segmentation_finds_separate_groups(spark):
    centers = [(5, 40, 9000), (30, 20, 4000), (200, 5, 800), (500, 1, 50)]
    rng = np.random.default_rng(0)
    rows = [(g * 100 + i, int(r + rng.integers(0, 4)), int(f + rng.integers(0, 2)), float(m + rng.integers(0, 20)))
            for g, (r, f, m) in enumerate(centers) for i in range(40)]
    rfm = spark.createDataFrame(rows, "customer_id int, recency_days int, frequency int, monetary double")
    found, sweep = segments.run_segmentation(rfm, restarts=2)
    assert sweep.best_k == 4 and sorted(sweep.models) == [4, 5, 6, 7]
    assert found.groupBy("cluster").count().select("count").distinct().collect()[0][0] == 40
    assert sweep.inertia[7] <= sweep.inertia[4]


@pytest.mark.parametrize("n, positive", [(100, 30), (101, 33), (57, 5), (857, 500)])
def test_split_is_exact_per_class(spark, n, positive):
    df = spark.range(n).select(F.col("id").alias("customer_id"), (F.col("id") < positive).cast("int").alias("churned"))
    got = churn.stratified_split(df)
    counts = {(r.churned, r.is_test): r["count"] for r in got.groupBy("churned", "is_test").count().collect()}
    tests = counts[0, True] + counts[1, True]
    assert tests == -(-n // 5)
    assert abs(counts[1, True] - positive * tests / n) <= 1
    again = {r.customer_id for r in churn.stratified_split(df.repartition(3)).where("is_test").collect()}
    assert again == {r.customer_id for r in got.where("is_test").collect()}


def test_folds_are_even_and_stratified(spark):
    df = spark.range(103).select(F.col("id").alias("customer_id"), (F.col("id") < 31).cast("int").alias("churned"))
    got = churn.stratified_folds(df).toPandas()
    assert set(got.groupby("fold").size()) == {20, 21}
    assert got[got.churned == 1].groupby("fold").size().between(6, 7).all()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "churned int")
    assert {r.churned: r.weight for r in churn.class_weights(df).collect()} == pytest.approx({0: 4 / 6, 1: 2.0})


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(3)
    actual = rng.integers(0, 2, 300)
    score = np.round(np.clip(actual * 0.3 + rng.random(300) * 0.7, 0, 1), 1)
    rows = [(i, int(a), int(s >= 0.5), float(s)) for i, (a, s) in enumerate(zip(actual, score, strict=True))]
    return spark.createDataFrame(rows, "customer_id int, actual_churned int, predicted_churned int, churn_probability double")


def test_roc_auc_counts_pairs(predictions):
    data = predictions.toPandas()
    pos, neg = (data[data.actual_churned == c].churn_probability.to_numpy() for c in (1, 0))
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert metrics.roc_auc(predictions).first().roc_auc == pytest.approx(pairs / (len(pos) * len(neg)))


def test_report_agrees_with_counts(predictions):
    data = predictions.toPandas()
    tp = ((data.actual_churned == 1) & (data.predicted_churned == 1)).sum()
    got = metrics.precision_recall_f1(predictions).first()
    assert got.precision == pytest.approx(tp / data.predicted_churned.sum())
    assert got.recall == pytest.approx(tp / data.actual_churned.sum())
    lines = {r["class"]: r for r in metrics.classification_report(predictions).collect()}
    assert lines["Churned"].f1_score == pytest.approx(got.f1_score)
    assert lines["accuracy"].precision == pytest.approx((data.actual_churned == data.predicted_churned).mean())
    assert lines["macro avg"].support == 300
    matrix = [tuple(r) for r in metrics.confusion_matrix(predictions).collect()]
    assert matrix[1][2] == tp and sum(m[1] + m[2] for m in matrix) == 300


def test_forest_wins_ties():
    assert churn.best_model({"roc_auc": 0.9}, {"roc_auc": 0.9}) == churn.FOREST
    assert churn.best_model({"roc_auc": 0.91}, {"roc_auc": 0.9}) == churn.LOGISTIC


@pytest.fixture(scope="module")
def small_forest(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, 3)).round(3)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4) | (rng.random(400) > 0.9)).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "customer_id int, a double, b double, c double, churned int")
    rows = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df)
    return churn.fit_forest(rows, settings=churn.ForestSettings(trees=5, depth=4, min_leaf=3, bins=32)), rows


def _conditional(nodes, at, x, known):
    row = nodes[at]
    if row["left"] < 0:
        return row["value"]
    if row["feature"] in known:
        return _conditional(nodes, row["left"] if x[int(row["feature"])] <= row["threshold"] else row["right"], x, known)
    parts = [nodes[row["left"]], nodes[row["right"]]]
    return sum(p["cover"] / row["cover"] * _conditional(nodes, p["node"], x, known) for p in parts)


def test_shap_equals_the_sum_over_coalitions(spark, small_forest):
    model, rows = small_forest
    some = rows.where("customer_id < 12")
    phi, base = explain.forest_shap(model, some, COLUMNS, batch=5)
    got = phi.toPandas().pivot(index="customer_id", columns="feature", values="phi")
    trees = [{int(r["node"]): r for r in t.to_dict("records")} for _, t in explain.tree_nodes(spark, model).toPandas().groupby("tree")]
    for r in some.collect():
        x = [r.a, r.b, r.c]

        def value(known):
            return np.mean([_conditional(t, 0, x, known) for t in trees])

        assert value(set()) == pytest.approx(base)
        for j, name in enumerate(COLUMNS):
            others = [i for i in range(3) if i != j]
            want = sum(
                factorial(len(s)) * factorial(2 - len(s)) / factorial(3) * (value({*s, j}) - value(set(s)))
                for size in range(3) for s in combinations(others, size))
            assert got.loc[r.customer_id, name] == pytest.approx(want, abs=1e-12)


def test_shap_adds_up_to_the_probability(spark, small_forest):
    model, rows = small_forest
    phi, base = explain.forest_shap(model, rows, COLUMNS)
    sums = phi.groupBy("customer_id").agg(F.sum("phi").alias("s"))
    data = churn.scored(model, rows).join(sums, "customer_id").toPandas()
    assert len(data) == 400 and np.abs(data.s + base - data.score).max() < 1e-12
    top = explain.global_importance(phi).collect()
    assert {top[0].feature, top[1].feature} == {"a", "b"}
    predictions = churn.predictions_table(churn.scored(model, rows))
    local = explain.local_explanation(phi, predictions, base, n=2).collect()
    best = predictions.toPandas().sort_values(["churn_probability", "customer_id"], ascending=[False, True]).iloc[0]
    assert {r.customer_id for r in local} == {best.customer_id} and abs(local[0].phi) >= abs(local[1].phi)


def test_logistic_matches_a_newton_solution(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=300) > 0.7).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"customer_id": range(300), "a": x[:, 0], "b": x[:, 1], "churned": y}))
    model, _ = churn.fit_logistic(df, cols=["a", "b"])
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(300)])
    w = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    beta, ridge = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + ridge, z.T @ (w * (p - y)) + ridge @ beta)
    fitted = [*model.stages[-1].coefficients, model.stages[-1].intercept]
    assert fitted == pytest.approx(beta.tolist(), abs=1e-3)


def test_silhouette_reads_all_rows_in_any_order(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 4000), rng.normal(9, 1, 1000)])
    rows = [(float(v), int(i >= 4000)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, l int")
    got = [segments.squared_silhouette(d, ["x"], ["l"]).first().silhouette for d in (df, df.orderBy(F.desc("l")))]
    assert got[0] == pytest.approx(got[1]) and got[0] > 0.8


def test_the_forest_does_not_depend_on_the_input_partitions(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, float(a), float(b), int(a + b > 1)) for i, (a, b) in enumerate(rng.random((600, 2)))], "customer_id int, a double, b double, churned int")
    matrix = churn.feature_matrix(rows, ["a", "b"])
    settings = churn.ForestSettings(trees=5, depth=4, min_leaf=3, bins=32, partitions=4)
    scores = [
        sorted(map(tuple, churn.scored(churn.fit_forest(m, settings=settings), matrix).select("customer_id", "score").collect()))
        for m in (matrix.coalesce(1), matrix.repartition(8))
    ]
    assert scores[0] == scores[1]


def test_shap_values_do_not_depend_on_the_block_of_leaves(spark, monkeypatch):
    rng = np.random.default_rng(5)
    packed = {
        size: (
            np.stack([rng.permutation(5)[:size] for _ in range(50)]), rng.random((50, size)) - 0.6, rng.random((50, size)) + 0.3, rng.random((50, size)), rng.random(50),
        )
        for size in (1, 3, 4)
    }
    x = rng.random((20, 5))
    whole = explain.path_contributions(x, packed)
    monkeypatch.setattr(explain, "LEAVES", 7)
    assert np.abs(explain.path_contributions(x, packed) - whole).max() < 1e-12


def test_tabled_contributions_are_shapley_values_of_every_set():
    """Against all coalitions of the features of a path."""
    rng = np.random.default_rng(6)
    share, value = rng.random((3, 4)), rng.random(3)
    tables = explain.contribution_tables(share, value)

    def worth(leaf, met, known):
        return value[leaf] * np.prod([(met >> i & 1) if known >> i & 1 else share[leaf, i] for i in range(4)])

    for leaf in range(3):
        for met in range(16):
            for j in range(4):
                want = 0.0
                for known in (s for s in range(16) if not s >> j & 1):
                    weight = 1 / (4 * comb(3, known.bit_count()))
                    want += weight * (worth(leaf, met, known | 1 << j) - worth(leaf, met, known))
                assert tables[j, leaf, met] == pytest.approx(want, abs=1e-12)


def test_tabled_and_row_by_row_contributions_agree(monkeypatch):
    rng = np.random.default_rng(7)
    packed = {
        size: (np.stack([rng.permutation(12)[:size] for _ in range(9)]), rng.random((9, size)) - 0.6, rng.random((9, size)) + 0.3, rng.random((9, size)), rng.random(9))
        for size in (1, 5, 9, 12)
    }
    x = rng.random((150, 12))
    tabled = explain.path_contributions(x, packed)
    monkeypatch.setattr(explain, "TABLED", 0)
    assert np.abs(explain.path_contributions(x, packed) - tabled).max() < 1e-12

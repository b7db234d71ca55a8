"""Churn classifiers: split, weights, training, cross-validation and scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark import schemas
from ledgerlark.functions.numeric import quotient
from ledgerlark.operators.metrics import model_metrics, roc_auc
from ledgerlark.operators.ranking import global_rank
from ledgerlark.operators.segments import Scaler, fit_scaler
from ledgerlark.session import in_threads, stage, tune

# The columns of the feature matrix, in order, and the names of the models.
CHURN_FEATURE_COLUMNS = [
    "age", "customer_tenure_days", "recency_days", "frequency", "monetary", "avg_order_value",
    "total_items_purchased", "unique_products_purchased", "unique_categories_purchased",
    "average_discount", "purchase_trend_ratio", "loyalty_points", "loyalty_tier_encoded",
]
FOREST = "Random Forest"
LOGISTIC = "Logistic Regression"


@dataclass
class ForestSettings:
    trees: int = 300
    depth: int = 8
    min_leaf: int = 5
    bins: int = 128
    memory_mb: int = 1024
    #: Tasks per training pass; raise it with the size of the training table.
    partitions: int = 16


def feature_matrix(df: DataFrame, cols: list[str] = CHURN_FEATURE_COLUMNS) -> DataFrame:
    """Doubles with null as 0, gathered in the vector `features`."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    return VectorAssembler(inputCols=cols, outputCol="features").transform(filled)


def hash_order(key: str, seed: int) -> Column:
    """A fixed pseudo-random order of the keys."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def _shuffled(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    return global_rank(df.withColumn("_mix", hash_order(key, seed)), [label, "_mix", key], name="_place").drop("_mix")


def _train_quota(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    """(label, _before, _train): training rows per class by largest remainder.

    One row per class comes in. The whole split has ceil(share * n) test rows.
    """
    totals = counts.agg(F.sum("n").alias("all")).scalar()
    wanted = counts.withColumn("_all", totals)
    train = F.col("_all") - F.ceil(F.col("_all") * F.lit(str(test_share)).cast("decimal(9,6)"))
    exact = F.col("n").cast("decimal(20,0)") * train.cast("decimal(18,0)")
    parts = wanted.select(
        label, "n", "_all", train.alias("_want"),
        F.call_function("div", exact, F.col("_all")).alias("_floor"),
        (exact % F.col("_all")).alias("_rest"),
    )
    every = Window.partitionBy()
    missing = F.col("_want") - F.sum("_floor").over(every)
    turn = F.row_number().over(Window.orderBy(F.desc("_rest"), label))
    before = F.coalesce(F.sum("n").over(Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.select(
        F.col(label).alias("_label"), before.alias("_before"),
        (F.col("_floor") + F.when(turn <= missing, 1).otherwise(0)).alias("_train"),
    )


def stratified_split(
    df: DataFrame, key: str = "customer_id", label: str = "churned", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `is_test`: the exact share of each class, chosen by a seeded hash of the key."""
    placed = _shuffled(df, key, label, seed)
    quota = _train_quota(placed.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label, test_share)
    # One row per class is broadcast.
    joined = placed.join(F.broadcast(quota), F.col(label) == F.col("_label"))
    return joined.withColumn("is_test", F.col("_place") - F.col("_before") > F.col("_train")).drop(
        "_place", "_label", "_before", "_train"
    )


def stratified_folds(
    df: DataFrame, key: str = "customer_id", label: str = "churned", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add `fold` 0..folds-1: rows sorted by class and hash, dealt out in turn."""
    return _shuffled(df, key, label, seed).withColumn("fold", ((F.col("_place") - 1) % folds).cast("int")).drop("_place")


def class_weights(df: DataFrame, label: str = "churned") -> DataFrame:
    """(label, rows, weight) with weight = rows in all / (classes * rows in the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k"))
    n, k = whole.select("n").scalar(), whole.select("k").scalar()
    return counts.withColumn("weight", n.cast("double") / (k * F.col("rows")).cast("double"))


def with_weights(df: DataFrame, label: str = "churned") -> DataFrame:
    # One row per class is broadcast.
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def _dealt(df: DataFrame, partitions: int, key: str = "customer_id") -> DataFrame:
    """The training rows by hash of the key, sorted inside each partition.

    The bootstrap draws by partition, so with a fixed number of partitions the same rows give
    the same model on any cluster.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def train_summary(train: DataFrame, label: str = "churned") -> DataFrame:
    return train.agg(
        F.count(F.lit(1)).alias("train_rows"), quotient(F.sum(label), F.count(label)).alias("churn_rate")
    )


def _as_stage(columns: dict[str, str]) -> SQLTransformer:
    """A pipeline stage that adds columns given as SQL, so that it is saved with the model."""
    return SQLTransformer(statement="SELECT *, " + ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items()) + " FROM __THIS__")


def _filled(c: str) -> str:
    return f"coalesce(CAST(`{c}` AS DOUBLE), 0D)"


def on_raw_rows(model, cols: list[str] = CHURN_FEATURE_COLUMNS) -> PipelineModel:
    """A model of `feature_matrix` with the matrix as its first stages: it scores raw customer rows."""
    return PipelineModel([
        _as_stage({f"{c}_f": _filled(c) for c in cols}), VectorAssembler(inputCols=[f"{c}_f" for c in cols], outputCol="features"), model,
    ])


def fit_logistic(
    train: DataFrame, label: str = "churned", cols: list[str] = CHURN_FEATURE_COLUMNS, partitions: int = 16
) -> tuple[PipelineModel, Scaler]:
    """L2 logistic regression with C = 1 on columns scaled by the training rows.

    The scaling is the pipeline's first stage, so the saved model scores raw customer rows (without
    a column `features`). Balanced weights add up to the number of rows, so a penalty of 1/rows on the mean loss
    is the same objective as a sum of losses with C = 1.
    """
    scaler = fit_scaler(train, cols)
    rows = train.count()
    scale = {f"{c}_z": f"({_filled(c)} - ({scaler.means[c]!r}D)) / ({scaler.deviations[c] or 1.0!r}D)" for c in cols}
    stages = [
        _as_stage(scale),
        VectorAssembler(inputCols=[f"{c}_z" for c in cols], outputCol="features"),
        LogisticRegression(
            labelCol=label, weightCol="weight", regParam=1.0 / rows, elasticNetParam=0.0,
            standardization=False, maxIter=1000, tol=1e-6,
        ),
    ]
    return Pipeline(stages=stages).fit(_dealt(with_weights(train, label), partitions)), scaler


def fit_forest(train: DataFrame, label: str = "churned", seed: int = 42, settings: ForestSettings | None = None):
    """Random forest on the unscaled matrix of `feature_matrix`."""
    s = settings or ForestSettings()
    return RandomForestClassifier(
        labelCol=label, weightCol="weight", numTrees=s.trees, maxDepth=s.depth, minInstancesPerNode=s.min_leaf,
        featureSubsetStrategy="sqrt", maxBins=s.bins, maxMemoryInMB=s.memory_mb, seed=seed,
    ).fit(_dealt(with_weights(train, label), s.partitions))


def scored(model, df: DataFrame, label: str = "churned", key: str = "customer_id") -> DataFrame:
    """(customer_id, actual_churned, predicted_churned, score) with the unrounded probability."""
    return model.transform(df).select(
        key,
        F.col(label).cast("int").alias("actual_churned"),
        F.col("prediction").cast("int").alias("predicted_churned"),
        vector_to_array("probability")[1].alias("score"),
    )


def predictions_table(rows: DataFrame) -> DataFrame:
    return rows.select(
        "customer_id", "actual_churned", "predicted_churned", F.bround("score", 4).alias("churn_probability")
    )


def cross_validate(
    df: DataFrame, label: str = "churned", folds: int = 5, seed: int = 42, settings: ForestSettings | None = None
) -> DataFrame:
    """(fold, roc_auc) of forests trained on the other folds, with weights of their own rows."""
    dealt = stage(stratified_folds(df, label=label, folds=folds, seed=seed), "folds")

    def area(fold: int) -> tuple[int, float]:
        model = fit_forest(dealt.where(F.col("fold") != fold), label, seed, settings)
        held = scored(model, dealt.where(F.col("fold") == fold), label)
        return fold, roc_auc(held, "score").first()["roc_auc"]

    spark = df.sparkSession
    areas = in_threads(spark, area, range(folds), folds)
    return spark.createDataFrame(areas, "fold int, roc_auc double")


def best_model(logistic: dict, forest: dict) -> str:
    """The higher rounded area under the curve; the forest on a tie."""
    return FOREST if forest["roc_auc"] >= logistic["roc_auc"] else LOGISTIC


def model_record(logistic: dict, forest: dict, areas: list[float]) -> dict:
    """What is kept of a training run: both models' measures, the better one, and the folds' areas."""
    return {
        "best_model": best_model(logistic, forest),
        "logistic_regression": logistic,
        "random_forest": forest,
        "random_forest_cv_roc_auc_mean": round(float(np.mean(areas)), 3),
        "random_forest_cv_roc_auc_std": round(float(np.std(areas)), 3),
        "churn_feature_columns": CHURN_FEATURE_COLUMNS,
    }


def comparison_table(spark, record: dict) -> DataFrame:
    return spark.createDataFrame([record["logistic_regression"], record["random_forest"]], schemas.METRICS)


@dataclass
class ChurnRun:
    """What training leaves behind."""

    split: DataFrame
    forest: object
    logistic: PipelineModel
    scaler: Scaler
    test_scores: dict[str, DataFrame]
    folds: DataFrame
    record: dict

    @property
    def best_name(self) -> str:
        return self.record["best_model"]

    def best_model(self) -> PipelineModel:
        """The better model, ready to score raw customer rows."""
        return on_raw_rows(self.forest) if self.best_name == FOREST else self.logistic

    def predictions(self) -> DataFrame:
        return predictions_table(self.test_scores[self.best_name])

    def metrics_table(self, spark) -> DataFrame:
        return comparison_table(spark, self.record)

    def record_table(self, spark) -> DataFrame:
        return spark.createDataFrame([self.record], schemas.MODEL_RECORD)


def train_churn_models(
    dataset: DataFrame, seed: int = 42, settings: ForestSettings | None = None, folds: int = 5
) -> ChurnRun:
    """Both classifiers on one split, compared on the same test rows."""
    tune(dataset.sparkSession)
    split = stage(stratified_split(feature_matrix(dataset), seed=seed), "split")
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    partitions = (settings or ForestSettings()).partitions
    logistic, scaler = fit_logistic(train.drop("features"), partitions=partitions)
    forest = fit_forest(train, seed=seed, settings=settings)
    scores = {
        LOGISTIC: stage(scored(logistic, test.drop("features")), "logistic"),
        FOREST: stage(scored(forest, test), "forest"),
    }
    logistic_record = model_metrics(scores[LOGISTIC], LOGISTIC)
    forest_record = model_metrics(scores[FOREST], FOREST)
    validated = cross_validate(split.drop("is_test"), folds=folds, seed=seed, settings=settings)
    record = model_record(logistic_record, forest_record, [r["roc_auc"] for r in validated.collect()])
    return ChurnRun(split, forest, logistic, scaler, scores, validated, record)

"""Measures of a binary classifier, computed from a table of predictions.

The tables have columns `actual_churned`, `predicted_churned` (0 or 1) and a score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.numeric import quotient
from ledgerlark.operators.ranking import running_total

CLASS_NAMES = {0: "Not Churned", 1: "Churned"}


def _zero(col):
    return F.coalesce(col, F.lit(0.0))


def _f1(tp, predicted, actual):
    return _zero(quotient(2 * tp, predicted + actual))


def precision_recall_f1(predictions: DataFrame) -> DataFrame:
    """For class 1, unrounded; 0 where a denominator is 0."""
    hit = (F.col("actual_churned") == 1) & (F.col("predicted_churned") == 1)
    counts = predictions.agg(
        F.count_if(hit).alias("tp"), F.sum("predicted_churned").alias("p"), F.sum("actual_churned").alias("a")
    )
    tp, p, a = F.col("tp"), F.col("p"), F.col("a")
    return counts.select(
        _zero(quotient(tp, p)).alias("precision"), _zero(quotient(tp, a)).alias("recall"), _f1(tp, p, a).alias("f1_score")
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """(actual, predicted_0, predicted_1), both classes present."""
    counts = predictions.groupBy(F.col("actual_churned").alias("actual")).pivot("predicted_churned", [0, 1]).count()
    classes = predictions.sparkSession.createDataFrame([(0,), (1,)], "actual int")
    return classes.join(counts, "actual", "left").select(
        "actual", F.coalesce("0", F.lit(0)).alias("predicted_0"), F.coalesce("1", F.lit(0)).alias("predicted_1")
    ).orderBy("actual")


def roc_auc(predictions: DataFrame, score: str = "churn_probability") -> DataFrame:
    """Exact area under the curve with ties, from rank sums over the distinct scores."""
    label = F.col("actual_churned")
    counts = predictions.groupBy(F.col(score).alias("score")).agg(
        F.sum(label).cast("long").alias("pos"), F.sum(1 - label).cast("long").alias("neg")
    )
    below = running_total(counts, ["score"], "neg", name="upto")
    # Twice the pairs won: negatives below count 2, negatives at the same score 1.
    won = F.sum(F.col("pos").cast("decimal(19,0)") * (2 * F.col("upto") - F.col("neg")).cast("decimal(19,0)"))
    return below.agg(
        quotient(won, 2 * F.sum("pos").cast("decimal(19,0)") * F.sum("neg").cast("decimal(19,0)")).alias("roc_auc")
    )


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    cells = predictions.groupBy("actual_churned", "predicted_churned").agg(F.count(F.lit(1)).alias("n"))
    a, p, n = F.col("actual_churned"), F.col("predicted_churned"), F.col("n")
    sums = cells.agg(*[
        F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).alias(name)
        for c in (0, 1)
        for name, cond in ((f"tp{c}", (a == c) & (p == c)), (f"p{c}", p == c), (f"a{c}", a == c))
    ])

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"),
            support.cast("long").alias("support"),
        )

    per = {}
    for c in (0, 1):
        tp, pred, act = F.col(f"tp{c}"), F.col(f"p{c}"), F.col(f"a{c}")
        per[c] = (_zero(quotient(tp, pred)), _zero(quotient(tp, act)), _f1(tp, pred, act), act)
    both = F.col("a0") + F.col("a1")
    right = _zero(quotient(F.col("tp0") + F.col("tp1"), both))
    macro = [(per[0][i] + per[1][i]) / 2 for i in range(3)]
    weighted = [_zero(quotient(per[0][i] * F.col("a0") + per[1][i] * F.col("a1"), both)) for i in range(3)]
    return sums.select(F.inline(F.array(
        line(CLASS_NAMES[0], *per[0]), line(CLASS_NAMES[1], *per[1]), line("accuracy", right, right, right, both),
        line("macro avg", *macro, both), line("weighted avg", *weighted, both),
    )))


def model_metrics(predictions: DataFrame, model: str, score: str = "score") -> dict:
    """One rounded record of a model's measures, for comparing models on the driver."""
    quality = precision_recall_f1(predictions).first()
    area = roc_auc(predictions, score).first()["roc_auc"]
    return {"model": model, **{c: round(quality[c], 3) for c in quality.__fields__}, "roc_auc": round(area, 3)}

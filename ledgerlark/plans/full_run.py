"""The whole analysis from raw tables to written outputs.

Each step writes its tables and the next reads them back, so no plan grows over the whole run
and a lost executor costs one step at most.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.operators import churn, cleaning, explain, features, metrics, segments, star
from ledgerlark.operators.colocated import colocate, with_headers
from ledgerlark.plans import extracts, reports
from ledgerlark.session import staging_scope, tune
from ledgerlark.sources import tables as io


class Outputs:
    """Tables under one folder: `save` writes one and returns what was written."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.tables: dict[str, DataFrame] = {}

    def save(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        io.write_parquet(df, path)
        self.tables[name] = io.read_parquet(self.spark, path, df.schema)
        return self.tables[name]

    def save_all(self, bundle: dict[str, DataFrame], prefix: str) -> None:
        for name, df in bundle.items():
            self.save(f"{prefix}/{name}", df)


def run_all(
    spark: SparkSession, customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, folder: str,
    reference: date, arrival: list[str] | None = None, settings: churn.ForestSettings | None = None, restarts: int = 10,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Clean, build features and the star, segment, train, explain, report and extract.

    The tables returned are those written to `folder`; what was staged on the way is deleted.
    `arrival` names the columns that say which of several copies of an id came first.
    """
    with staging_scope(spark):
        return _run(spark, customers, products, orders, items, folder, reference, arrival, settings, restarts, seed)


def _run(spark, customers, products, orders, items, folder, reference, arrival, settings, restarts, seed) -> dict[str, DataFrame]:
    tune(spark)
    out = Outputs(spark, folder)
    cutoff, end = features.study_dates(reference)

    clean = cleaning.clean_tables(customers, products, orders, items, arrival)
    c = out.save("customers", clean.customers)
    p = out.save("products", clean.products)
    o = out.save("orders", clean.orders)
    i = out.save("order_items", clean.order_items)
    out.save("data_quality_report", clean.report)

    rfm = out.save("rfm_features", features.add_rfm_scores(features.build_rfm_features(c, o, cutoff)))
    feats = out.save("customer_features", features.build_customer_features(c, o, i, p, cutoff))
    dataset = out.save("churn_dataset", features.churn_dataset(feats, features.build_churn_labels(o, c, cutoff, end)))

    placed = colocate(o, i)
    dates = star.date_dimension(o)
    fact = star.fact_from_lines(with_headers(placed, "inner", star.HEADER_CONTEXT))
    io.write_star(spark, f"{out.folder}/star", {"dim_customer": c, "dim_product": p, "dim_date": dates}, fact)

    segs, sweep = segments.run_segmentation(rfm, seed=seed, restarts=restarts)
    segs = out.save("customer_segments", segs)
    out.save("k_sweep", sweep.table(spark))

    run = churn.train_churn_models(dataset, seed=seed, settings=settings)
    predictions = out.save("churn_predictions", run.predictions())
    io.write_json(run.record_table(spark), f"{out.folder}/model_metrics")
    run.best_model().write().overwrite().save(f"{out.folder}/best_churn_model")
    comparison = out.save("model_comparison", run.metrics_table(spark))
    for name, scores in run.test_scores.items():
        prefix = name.lower().replace(" ", "_")
        out.save(f"{prefix}_confusion_matrix", metrics.confusion_matrix(scores))
        out.save(f"{prefix}_classification_report", metrics.classification_report(scores))

    importance = None
    if run.best_name == churn.FOREST:
        phi, base = explain.forest_shap(run.forest, run.split.where("is_test"), churn.CHURN_FEATURE_COLUMNS)
        phi = out.save("shap_values", phi)
        importance = out.save("shap_feature_importance", explain.global_importance(phi))
        out.save("shap_local_example", explain.local_explanation(phi, predictions, base))
    else:
        out.save("linear_coefficients", explain.linear_coefficients(spark, run.logistic, churn.CHURN_FEATURE_COLUMNS))

    out.save_all(reports.report_bundle(c, p, o, i, segs, predictions, importance, comparison, placed), "report")
    out.save_all(extracts.extract_bundle(c, p, o, i, feats, segs, predictions, placed), "extracts")
    return out.tables

"""The exploratory tables: shapes, distributions and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.encode import band, place
from ledgerlark.functions.numeric import amount, mean
from ledgerlark.operators.aggregates import frequency
from ledgerlark.operators.joins import join_star
from ledgerlark.operators.ranking import top_k

# Order of the tiers and the five inactivity bands, closed on the right.
TIER_ORDER = ["Bronze", "Silver", "Gold", "Platinum"]
INACTIVITY_EDGES = [-1, 30, 90, 180, 365, 10000]
INACTIVITY_LABELS = ["0-30 days", "31-90 days", "91-180 days", "181-365 days", "365+ days"]


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def customers_by_region(customers: DataFrame) -> DataFrame:
    return frequency(customers, "region", name="customers")


def customers_by_tier(customers: DataFrame) -> DataFrame:
    return frequency(customers, "loyalty_tier", TIER_ORDER, name="customers")


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    sums = items.groupBy("product_id").agg(F.sum("line_total").alias("sum"))
    named = join_star(sums, products, "product_id", "inner", ["category"])
    return named.groupBy("category").agg(amount(F.sum("sum")).alias("revenue")).orderBy(F.desc("revenue"), "category")


def score_frequencies(scores: DataFrame, n: int = 20) -> DataFrame:
    """The first `n` score combinations in order of the score."""
    counts = scores.groupBy("RFM_score").agg(F.count(F.lit(1)).alias("customers"))
    return top_k(counts, ["RFM_score"], n)


def tier_summary(features: DataFrame) -> DataFrame:
    """Means per tier in fixed order; a tier without customers has nulls."""
    sums = features.groupBy("loyalty_tier").agg(
        F.count("customer_id").alias("customers"), mean("monetary").alias("avg_monetary"),
        mean("frequency").alias("avg_frequency"), mean("recency_days").alias("avg_recency"),
    )
    spine = features.sparkSession.createDataFrame([(t,) for t in TIER_ORDER], "loyalty_tier string")
    return spine.join(sums, "loyalty_tier", "left").orderBy(place(F.col("loyalty_tier"), TIER_ORDER))


def inactivity_bands(features: DataFrame) -> DataFrame:
    """Customers per band of days since the last order, bands without customers null."""
    named = features.select(band(F.col("recency_days"), INACTIVITY_EDGES, INACTIVITY_LABELS).alias("inactivity_bucket"))
    return frequency(named, "inactivity_bucket", INACTIVITY_LABELS, name="customers")


def tenure_frequency_correlation(features: DataFrame) -> DataFrame:
    return features.agg(F.corr("customer_tenure_days", "frequency").alias("correlation"))

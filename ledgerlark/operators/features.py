"""RFM, behavioural features and the churn label, all as of a date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.encode import encode
from ledgerlark.functions.numeric import quotient
from ledgerlark.operators.joins import flag_absent
from ledgerlark.operators.ranking import common_number, global_rank, quantile_score

# Order of the tiers, length of the label window and of a trend window in days.
TIER_CODES = {"Bronze": 0, "Silver": 1, "Gold": 2, "Platinum": 3}
OBSERVATION_DAYS = 90
TREND_DAYS = 90

# The columns of the feature table.
FEATURE_COLUMNS = [
    "customer_id", "loyalty_tier", "loyalty_points", "region", "age", "gender",
    "customer_tenure_days", "recency_days", "frequency", "monetary", "avg_order_value",
    "total_items_purchased", "unique_products_purchased", "unique_categories_purchased",
    "average_discount", "purchase_trend_ratio", "loyalty_tier_encoded",
]


def study_dates(reference: date) -> tuple[date, date]:
    """(cutoff, end of the label window) for a reference date."""
    cutoff = reference - timedelta(days=OBSERVATION_DAYS)
    return cutoff, cutoff + timedelta(days=OBSERVATION_DAYS)


def _days_since(as_of: date, col):
    return F.greatest(F.datediff(F.lit(as_of), col), F.lit(0))


def order_stats(orders: DataFrame, as_of: date) -> DataFrame:
    """All per-customer order measures up to `as_of` in one pass and one shuffle."""
    day, total = F.col("order_date"), F.col("total_amount")
    recent = as_of - timedelta(days=TREND_DAYS)
    prior = as_of - timedelta(days=2 * TREND_DAYS)
    return (
        orders.where(day <= F.lit(as_of))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("frequency"),
            F.sum("total_amount").alias("monetary"),
            F.max(day).alias("last_purchase_date"),
            F.min(day).alias("first_purchase_date"),
            F.coalesce(F.sum(F.when(day > F.lit(recent), total)), F.lit(0)).alias("recent_spend"),
            F.coalesce(F.sum(F.when((day > F.lit(prior)) & (day <= F.lit(recent)), total)), F.lit(0)).alias("prior_spend"),
        )
    )


def _rfm_columns(as_of: date) -> dict:
    freq = F.coalesce("frequency", F.lit(0)).cast("long")
    spent = F.coalesce("monetary", F.lit(0))
    return {
        "recency_days": _days_since(as_of, F.coalesce("last_purchase_date", "signup_date")),
        "avg_order_value": F.when(freq > 0, quotient(spent, freq)).otherwise(F.lit(0.0)),
        "frequency": freq,
        "monetary": spent,
    }


def build_rfm_features(customers: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """One row per customer, also those without orders (recency from signup) or signed up later (0)."""
    joined = customers.select("customer_id", "signup_date").join(order_stats(orders, as_of), "customer_id", "left")
    return joined.withColumns(_rfm_columns(as_of)).select(
        "customer_id", "recency_days", "frequency", "monetary", "avg_order_value"
    )


def purchase_dates(orders: DataFrame, as_of: date) -> DataFrame:
    return order_stats(orders, as_of).select("customer_id", "first_purchase_date", "last_purchase_date")


def add_rfm_scores(rfm: DataFrame) -> DataFrame:
    """Quintile scores and the combined text; ties in a measure are ranked by customer_id.

    The three measures are ranked in one range shuffle of (measure, value, customer_id); their
    ranks come back to one row per customer by one aggregate, which is joined to the table.
    """
    measures = {"F": "frequency", "M": "monetary", "R": "recency_days"}
    common = common_number(rfm, list(measures.values()))
    long = rfm.select("customer_id", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(c).cast(common).alias("value")) for m, c in measures.items()
    ])).alias("_m")).select("customer_id", "_m.measure", "_m.value")
    ranked = global_rank(long, ["value", "customer_id"], within=["measure"])
    n = ranked.select(F.max(F.when(F.col("measure") == "R", F.col("rank"))).alias("n")).scalar()
    ranks = ranked.groupBy("customer_id").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("rank"))).alias(f"_{m}") for m in measures]
    ).withColumn("_n", n)
    result = rfm.join(ranks, "customer_id").select(
        *rfm.columns,
        quantile_score(F.col("_R"), F.col("_n"), ascending=False).alias("R_score"),
        quantile_score(F.col("_F"), F.col("_n")).alias("F_score"),
        quantile_score(F.col("_M"), F.col("_n")).alias("M_score"),
    )
    return result.withColumn("RFM_score", F.concat(*[F.col(f"{m}_score").cast("string") for m in "RFM"]))


def basket_stats(orders: DataFrame, items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Units, distinct products and categories, and mean discount per customer up to `as_of`.

    Lines are summed per customer and product before the product join, so that join and the
    distinct counts see one row per pair however often it was bought.
    """
    window = orders.where(F.col("order_date") <= F.lit(as_of)).select("order_id", "customer_id")
    pairs = (
        items.join(window, "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("quantity").alias("units"), F.sum("discount").alias("discounts"), F.count("discount").alias("lines"))
    )
    named = pairs.join(products.select("product_id", "category"), "product_id", "left")
    return named.groupBy("customer_id").agg(
        F.sum("units").alias("total_items_purchased"),
        F.count("product_id").alias("unique_products_purchased"),
        F.count_distinct("category").alias("unique_categories_purchased"),
        quotient(F.sum("discounts"), F.sum("lines")).alias("average_discount"),
    )


def tenure(customers: DataFrame, as_of: date) -> DataFrame:
    return customers.select("customer_id", _days_since(as_of, F.col("signup_date")).alias("customer_tenure_days"))


def trend_ratio():
    recent, prior = F.coalesce("recent_spend", F.lit(0)), F.coalesce("prior_spend", F.lit(0))
    return (
        F.when(prior > 0, quotient(recent, prior)).when(recent > 0, F.lit(2.0)).otherwise(F.lit(1.0))
    )


def build_customer_features(
    customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, as_of: date
) -> DataFrame:
    """The 17-column feature table; every customer once, no nulls in the measures."""
    zero = {
        "total_items_purchased": F.lit(0).cast("long"), "unique_products_purchased": F.lit(0).cast("long"),
        "unique_categories_purchased": F.lit(0).cast("long"), "average_discount": F.lit(0.0),
    }
    joined = customers.join(order_stats(orders, as_of), "customer_id", "left").join(
        basket_stats(orders, items, products, as_of), "customer_id", "left"
    )
    return joined.withColumns({
        "customer_tenure_days": _days_since(as_of, F.col("signup_date")),
        **_rfm_columns(as_of),
        **{c: F.coalesce(c, v) for c, v in zero.items()},
        "purchase_trend_ratio": trend_ratio(),
        "loyalty_tier_encoded": encode(F.col("loyalty_tier"), TIER_CODES, 0),
    }).select(*FEATURE_COLUMNS)


def build_churn_labels(orders: DataFrame, customers: DataFrame, cutoff: date, obs_end: date) -> DataFrame:
    """1 for customers signed up by `cutoff` with no order in (cutoff, obs_end], else 0."""
    eligible = customers.where(F.col("signup_date") <= F.lit(cutoff)).select("customer_id")
    active = orders.where((F.col("order_date") > F.lit(cutoff)) & (F.col("order_date") <= F.lit(obs_end)))
    return flag_absent(eligible, active, "customer_id", "churned")


def churn_dataset(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, "customer_id", "inner")


def churn_rate(dataset: DataFrame) -> DataFrame:
    return dataset.agg(
        F.count(F.lit(1)).alias("customers"),
        quotient(F.sum("churned"), F.count("churned")).alias("churn_rate"),
    )

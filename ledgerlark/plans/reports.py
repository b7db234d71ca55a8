"""Aggregates of the management report and the lists it recommends.

`segments` has (customer_id, recency_days, frequency, monetary, segment); `predictions` has
(customer_id, actual_churned, predicted_churned, churn_probability).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.numeric import amount, mean, quotient
from ledgerlark.operators.aggregates import frequency, with_share
from ledgerlark.operators.colocated import Colocated, with_headers
from ledgerlark.operators.joins import join_star
from ledgerlark.operators.ranking import top_k
from ledgerlark.plans.business import per_order
from ledgerlark.session import stage

# Thresholds of the report (closed on the left) and of the retention lists.
HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
EXPORT_RISK = 0.6
LOYAL_RISK = 0.5

# The header columns that the regional report needs.
REGION_COLUMNS = ["store_region", "customer_id"]


def segment_summary(segments: DataFrame) -> DataFrame:
    sums = segments.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        *[F.bround(mean(c), 1).alias(f"avg_{c}") for c in ("recency_days", "frequency", "monetary")],
    )
    return with_share(sums, "customers", "pct_of_base").orderBy(F.desc("avg_monetary"), "segment")


def churn_summary(predictions: DataFrame) -> DataFrame:
    p = F.col("churn_probability")
    return predictions.agg(
        F.count(F.lit(1)).alias("scored_customers"),
        mean(p.cast("decimal(5,4)")).alias("avg_churn_probability"),
        F.count_if(p >= HIGH_RISK).alias("high_risk_count"),
        F.count_if((p >= MEDIUM_RISK) & (p < HIGH_RISK)).alias("medium_risk_count"),
        F.count_if(p < MEDIUM_RISK).alias("low_risk_count"),
        mean("actual_churned").alias("actual_churn_rate_in_test_set"),
    )


def _lines_per_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("line_total").alias("sum"), F.sum("quantity").alias("units"),
        F.sum("discount").alias("discounts"), F.count("discount").alias("lines"),
    )


def category_report(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines are summed per product before the join; products without category are left out."""
    return _categories(_lines_per_product(items), products)


def _categories(per_product: DataFrame, products: DataFrame) -> DataFrame:
    named = join_star(per_product, products, "product_id", "left", ["category"])
    sums = named.where(F.col("category").isNotNull()).groupBy("category").agg(
        amount(F.sum("sum")).alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.bround(quotient(F.sum("discounts"), F.sum("lines")), 2).alias("avg_discount"),
    )
    return with_share(sums, "revenue", "pct_of_revenue").orderBy(F.desc("revenue"), "category")


def regional_report(items: DataFrame, orders: DataFrame) -> DataFrame:
    return _regions(join_star(items, orders, "order_id", "left", REGION_COLUMNS))


def _regions(lines: DataFrame) -> DataFrame:
    sums = per_order(lines.where(F.col("store_region").isNotNull()), "store_region").groupBy("store_region").agg(
        amount(F.sum("sum")).alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
    )
    value = F.bround(quotient(F.col("revenue"), F.col("orders")), 2)
    return sums.withColumn("avg_order_value", value).orderBy(F.desc("revenue"), "store_region")


def bottom_products_report(items: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    return _bottom_products(_lines_per_product(items), products, n)


def _bottom_products(per_product: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    named = join_star(per_product, products, "product_id", "inner", ["product_name", "category"])
    return top_k(named, [F.asc("sum"), "product_id"], n).select(
        "product_id", "product_name", "category", amount("sum").alias("revenue"),
        quotient(F.col("discounts"), F.col("lines")).alias("avg_discount"),
    )


def headline(
    customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
    categories: DataFrame | None = None, regions: DataFrame | None = None, per_product: DataFrame | None = None,
) -> DataFrame:
    """One row: totals, and the categories and regions with most and least revenue.

    The two small reports behind the ends, and the sums per product from which the total and the
    categories come, are taken as given or staged, so that each is computed once.
    """
    per_product = stage(_lines_per_product(items), "products-sold") if per_product is None else per_product
    categories = stage(_categories(per_product, products), "categories") if categories is None else categories
    regions = stage(regional_report(items, orders), "regions") if regions is None else regions

    def ends(table: DataFrame, col: str, label: str) -> list:
        best = F.struct(-F.col("revenue"), F.col(col))
        worst = F.struct(F.col("revenue"), F.col(col))
        row = table.agg(F.struct(F.min_by(col, best).alias("best"), F.min_by(col, worst).alias("worst"))).scalar()
        return [row["best"].alias(f"best_{label}"), row["worst"].alias(f"worst_{label}")]

    return per_product.agg(amount(F.sum("sum")).alias("total_revenue")).select(
        "total_revenue",
        customers.agg(F.count(F.lit(1))).scalar().alias("total_customers"),
        orders.agg(F.count_distinct("order_id")).scalar().alias("total_orders"),
        *ends(categories, "category", "category"),
        *ends(regions, "store_region", "region"),
    )


def first_pass_segments(segments: DataFrame) -> DataFrame:
    return with_share(frequency(segments, "segment", name="customers"), "customers", "pct")


def first_pass_risk(predictions: DataFrame) -> DataFrame:
    p = F.col("churn_probability")
    return predictions.agg(
        F.count_if(p >= HIGH_RISK).alias("high_risk_count"), mean(p.cast("decimal(5,4)")).alias("avg_churn_probability")
    )


def high_risk_export(predictions: DataFrame, threshold: float = EXPORT_RISK) -> DataFrame:
    return predictions.where(F.col("churn_probability") >= threshold).select("customer_id", "churn_probability")


def retention_targets(segments: DataFrame, predictions: DataFrame, threshold: float = EXPORT_RISK) -> DataFrame:
    """Customers above the mean spend of their segment and at high risk.

    The means are one row per segment, joined back rather than taken in a window, which would
    sort a whole segment in one task.
    """
    means = segments.groupBy("segment").agg(mean("monetary").alias("segment_avg_monetary"))
    risky = high_risk_export(predictions, threshold)
    return (
        segments.select("customer_id", "segment", "monetary")
        .join(F.broadcast(means), "segment")
        .where(F.col("monetary").cast("double") > F.col("segment_avg_monetary"))
        .join(risky, "customer_id")
        .select("customer_id", "segment", "monetary", "segment_avg_monetary", "churn_probability")
    )


def segment_migration(before: DataFrame, after: DataFrame) -> DataFrame:
    """Customers per pair of segments in two snapshots; null where a customer is in one only."""
    a = before.select("customer_id", F.col("segment").alias("from_segment"))
    b = after.select("customer_id", F.col("segment").alias("to_segment"))
    return a.join(b, "customer_id", "full").groupBy("from_segment", "to_segment").agg(F.count(F.lit(1)).alias("customers"))


def segment_migration_by_ranges(before: DataFrame, after: DataFrame, ranges: int = 4096) -> DataFrame:
    """`segment_migration` of snapshots that hold each customer once and differ in few places.

    Customers are dealt into `ranges` by hash. Each snapshot adds up, per range and segment, its
    rows and two hashes of them, whatever their order. Where the sums of a range are equal, so are its
    customers, and they are counted from the sums; only the rows of other ranges are joined. Customers
    without id are nobody's match.
    """
    place = F.pmod(F.xxhash64("customer_id"), F.lit(ranges)).cast("int")
    a = before.select("customer_id", "segment", place.alias("_range"))
    b = after.select("customer_id", "segment", place.alias("_range"))
    keys = [F.xxhash64("customer_id", "segment"), F.xxhash64("segment", "customer_id", F.lit(1))]

    def tally(rows: DataFrame) -> DataFrame:
        known = rows.where(F.col("customer_id").isNotNull())
        return known.groupBy("_range", "segment").agg(
            F.count(F.lit(1)).alias("_n"), *[F.sum(k.cast("decimal(20,0)")).alias(f"_h{i}") for i, k in enumerate(keys)]
        )

    def whole(tallied: DataFrame, name: str) -> DataFrame:
        return tallied.groupBy("_range").agg(F.array(F.sum("_n").cast("decimal(38,0)"), F.sum("_h0"), F.sum("_h1")).alias(name))

    first = tally(a)
    sums = whole(first, "_a").join(whole(tally(b), "_b"), "_range", "full")
    # One number for each range that differs: at most `ranges`.
    off = F.broadcast(sums.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("_range"))
    same = first.join(off, "_range", "left_anti").groupBy("segment").agg(F.sum("_n").alias("customers"))
    same = same.select(F.col("segment").alias("from_segment"), F.col("segment").alias("to_segment"), "customers")

    def moved(rows: DataFrame) -> DataFrame:
        differs = rows.where(F.col("customer_id").isNotNull()).join(off, "_range", "left_semi")
        return differs.unionByName(rows.where(F.col("customer_id").isNull()).select(differs.columns)).drop("_range")

    pairs = segment_migration(moved(a), moved(b)).unionByName(same)
    return pairs.groupBy("from_segment", "to_segment").agg(F.sum("customers").alias("customers"))


def category_by_region(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category and region with subtotals (null = all), in long form."""
    sums = sales.groupBy("product_id", "store_region").agg(F.sum("line_total").alias("sum"))
    named = join_star(sums, products, "product_id", "inner", ["category"])
    return named.cube("category", "store_region").agg(amount(F.sum("sum")).alias("revenue"))


def category_region_matrix(sales: DataFrame, products: DataFrame, regions: list[str]) -> DataFrame:
    """One row per category, one column per region of the list."""
    sums = sales.groupBy("product_id", "store_region").agg(F.sum("line_total").alias("sum"))
    named = join_star(sums, products, "product_id", "inner", ["category"])
    return named.groupBy("category").pivot("store_region", regions).agg(amount(F.sum("sum")))


def discount_dependent(items: DataFrame, products: DataFrame, by: str = "category") -> DataFrame:
    """Groups with less than the mean revenue share and more than the mean discount.

    `by` is "category" or "product_id". The mean is taken over the groups; a group's share is
    below average exactly if its revenue is.
    """
    sums = _lines_per_product(items)
    if by != "product_id":
        named = join_star(sums, products, "product_id", "inner", [by])
        sums = named.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("sum", "units", "discounts", "lines")])
    sums = sums.withColumn("avg_discount", quotient(F.col("discounts"), F.col("lines")))
    whole = sums.agg(
        F.struct(
            F.sum("sum").alias("revenue"), F.count(F.lit(1)).alias("groups"),
            quotient(F.sum("discounts"), F.sum("lines")).alias("discount"),
        )
    ).scalar()
    low = F.col("sum").cast("double") * whole["groups"] < whole["revenue"].cast("double")
    return sums.where(low & (F.col("avg_discount") > whole["discount"])).select(
        by, amount("sum").alias("revenue"),
        F.bround(quotient(F.col("sum"), whole["revenue"]) * 100, 4).alias("pct_of_revenue"),
        F.bround("avg_discount", 6).alias("avg_discount"),
    )


def loyal_at_risk(segments: DataFrame, predictions: DataFrame, threshold: float = LOYAL_RISK) -> DataFrame:
    """Champions and loyal customers with a probability above the threshold."""
    loyal = segments.where(F.col("segment").isin("Champions", "Loyal Customers")).select("customer_id", "segment")
    risky = predictions.where(F.col("churn_probability") > threshold).select("customer_id", "churn_probability")
    return loyal.join(risky, "customer_id")


def report_bundle(
    customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, segments: DataFrame,
    predictions: DataFrame, importance: DataFrame | None = None, comparison: DataFrame | None = None,
    placed: Colocated | None = None,
) -> dict[str, DataFrame]:
    """Every table of the report by name, ready to be written side by side.

    `importance` and `comparison` (the measures of both models) come from a training run. Lines are
    read twice: for their sums per product, and with their orders, which need no shuffle where both
    are laid out together in `placed`.
    """
    per_product = stage(_lines_per_product(items), "products-sold")
    categories = stage(_categories(per_product, products), "categories")
    if placed is None:
        regions = stage(regional_report(items, orders), "regions")
    else:
        regions = stage(_regions(with_headers(placed, "left", REGION_COLUMNS)), "regions")
    bundle = {
        "headline": headline(customers, orders, items, products, categories, regions, per_product),
        "segment_summary": segment_summary(segments),
        "churn_summary": churn_summary(predictions),
        "category_performance": categories.orderBy(F.desc("revenue"), "category"),
        "regional_performance": regions.orderBy(F.desc("revenue"), "store_region"),
        "bottom_products": _bottom_products(per_product, products),
        "high_risk": high_risk_export(predictions),
        "retention_targets": retention_targets(segments, predictions),
    }
    if importance is not None:
        bundle["top_drivers"] = top_k(importance, [F.desc("mean_abs_shap"), "feature"], 5)
    if comparison is not None:
        bundle["model_metrics"] = comparison
    return bundle

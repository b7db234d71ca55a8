"""BI measures as functions of a sales or customer table and optional slicers.

Without slicers a measure gives one row; with slicers one row per value of these columns.
`sales` is the fact, with any customer or product columns that are to slice it joined on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.numeric import amount, mean, quotient, whole_division
from ledgerlark.operators.joins import join_star
from ledgerlark.operators.ranking import top_k

HIGH_RISK = 0.6


def sliced(sales: DataFrame, where: dict | None = None) -> DataFrame:
    """Keep rows whose columns have one of the values chosen in each slicer."""
    for col, values in (where or {}).items():
        sales = sales.where(F.col(col).isin(*(values if isinstance(values, (list, tuple)) else [values])))
    return sales


def sales_model(sales: DataFrame, customers: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """The fact with every slicer: year, month, region, tier, segment; channel is there already."""
    model = join_star(sales, customers, "customer_id", "inner", ["region", "loyalty_tier"])
    if segments is not None:
        model = join_star(model, segments, "customer_id", "left", ["segment"])
    return model.withColumns({"year": F.year("date_key"), "month": F.month("date_key")})


def _measure(df: DataFrame, by: list[str] | None, *measures: Column) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*measures)


def total_revenue(sales, by=None) -> DataFrame:
    return _measure(sales, by, amount(F.sum("line_total")).alias("total_revenue"))


def total_orders(sales, by=None) -> DataFrame:
    return _measure(sales, by, F.count_distinct("order_id").alias("total_orders"))


def total_customers(sales, by=None) -> DataFrame:
    return _measure(sales, by, F.count_distinct("customer_id").alias("total_customers"))


def average_order_value(sales, by=None) -> DataFrame:
    """0 where there are no orders."""
    value = F.coalesce(quotient(F.sum("line_total"), F.count_distinct("order_id")), F.lit(0.0))
    return _measure(sales, by, value.alias("average_order_value"))


def repeat_customer_rate(sales, by=None) -> DataFrame:
    """Fraction of customers with more than one order; 0 where there are no customers."""
    counts = sales.groupBy(*(by or []), "customer_id").agg(F.count_distinct("order_id").alias("n"))
    rate = F.coalesce(quotient(F.count_if(F.col("n") > 1), F.count(F.lit(1))), F.lit(0.0))
    return _measure(counts, by, rate.alias("repeat_customer_rate"))


def growth_by_calendar(sales: DataFrame) -> DataFrame:
    """Growth against the calendar month before; null where that month has no sales."""
    months = sales.groupBy(F.trunc("date_key", "MM").alias("month_start")).agg(F.sum("line_total").alias("sum"))
    prior = months.select(F.add_months("month_start", 1).alias("month_start"), F.col("sum").alias("prior"))
    return months.join(prior, "month_start", "left").select(
        "month_start", amount("sum").alias("revenue"), amount("prior").alias("prior_revenue"),
        quotient(F.col("sum") - F.col("prior"), F.col("prior")).alias("mom_revenue_growth"),
    ).orderBy("month_start")


def average_discount(sales, by=None) -> DataFrame:
    return _measure(sales, by, mean("discount").alias("average_discount"))


def high_risk_customers(customers, by=None) -> DataFrame:
    risky = F.when(F.col("churn_probability") >= HIGH_RISK, F.col("customer_id"))
    return _measure(customers, by, F.count_distinct(risky).alias("high_risk_customers"))


def average_churn_probability(customers, by=None) -> DataFrame:
    """Mean over customers that have a probability."""
    return _measure(customers, by, mean(F.col("churn_probability").cast("decimal(5,4)")).alias("average_churn_probability"))


def revenue_per_customer(sales, by=None) -> DataFrame:
    value = F.coalesce(quotient(F.sum("line_total"), F.count_distinct("customer_id")), F.lit(0.0))
    return _measure(sales, by, value.alias("revenue_per_customer"))


def slicer_cube(model: DataFrame, slicers: list[str]) -> DataFrame:
    """Revenue and orders for every combination of slicers, null meaning all.

    Lines are first summed per order and cell. Orders that lie in one cell, nearly all, are
    counted per cell, and the cube multiplies only the cells. An order that lies in several (its
    headers differ) is expanded itself, so it counts once in every cell of the cube.
    """
    orders = model.groupBy("order_id", *slicers).agg(F.sum("line_total").alias("sum"))
    spread = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_cells")).where("_cells > 1").select("order_id")
    single = orders.join(spread, "order_id", "left_anti").groupBy(*slicers).agg(F.sum("sum").alias("sum"), F.count(F.lit(1)).alias("orders"))
    several = orders.join(spread, "order_id", "left_semi")
    parts = single.cube(*slicers).agg(F.sum("sum").alias("sum"), F.sum("orders").alias("orders"), F.grouping_id().alias("_level")).unionByName(
        several.cube(*slicers).agg(F.sum("sum").alias("sum"), F.count_distinct("order_id").alias("orders"), F.grouping_id().alias("_level"))
    )
    # The cube of an empty table still has its overall row, without orders.
    return parts.groupBy("_level", *slicers).agg(
        amount(F.sum("sum")).alias("total_revenue"), F.sum("orders").alias("total_orders")
    ).drop("_level")


def revenue_by(sales: DataFrame, col: str) -> DataFrame:
    return total_revenue(sales, [col]).orderBy(F.desc("total_revenue"), col)


def top_products(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    sums = sales.groupBy("product_id").agg(F.sum("line_total").alias("sum"))
    named = join_star(sums, products, "product_id", "inner", ["product_name"])
    return top_k(named, [F.desc("sum"), "product_id"], n).select(
        "product_id", "product_name", amount("sum").alias("total_revenue")
    )


def revenue_and_orders_by_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.year("date_key").alias("year"), F.month("date_key").alias("month")).agg(
        amount(F.sum("line_total")).alias("total_revenue"), F.count_distinct("order_id").alias("total_orders")
    ).orderBy("year", "month")


def segment_distribution(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment")


def spend_by_tier(customers: DataFrame) -> DataFrame:
    return customers.groupBy("loyalty_tier").agg(mean("monetary").alias("avg_monetary")).orderBy("loyalty_tier")


def at_risk_table(customers: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    return customers.where(F.col("churn_probability") >= threshold).select(
        "customer_id", "name", "segment", "churn_probability"
    ).orderBy(F.desc("churn_probability"), "customer_id")


def probability_distribution(customers: DataFrame, bins: int = 10) -> DataFrame:
    """Customers per equal-width bin of [0, 1], the last closed."""
    p = F.col("churn_probability").cast("decimal(5,4)")
    return customers.where(p.isNotNull()).groupBy(
        F.least(whole_division(p * bins, F.lit(1).cast("decimal(1,0)")), F.lit(bins - 1).cast("long")).alias("bin")
    ).agg(F.count(F.lit(1)).alias("customers")).orderBy("bin")

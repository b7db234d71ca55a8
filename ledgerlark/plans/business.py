"""The seventeen business questions on the sales fact.

Each takes DataFrames, returns a DataFrame and lets Catalyst plan it. Year and month are
functions of the date key, so the monthly questions read them from the key and need no join.
Where a question has a limit, the key ends the order, so ties are settled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.functions.encode import place
from ledgerlark.functions.numeric import amount, ratio
from ledgerlark.functions.text import month_name
from ledgerlark.operators.joins import join_star
from ledgerlark.operators.ranking import top_k

# Names and order of the buckets.
INACTIVITY = ["0-30 days", "31-90 days", "91-180 days", "180+ days"]
ORDER_COUNTS = ["1 order", "2-3 orders", "4-6 orders", "7+ orders"]
DISCOUNTS = ["No discount", "1-10%", "11-20%", "20%+"]


def _orders() -> Column:
    return F.count_distinct("order_id")


def _revenue() -> Column:
    return F.sum("line_total")


def per_order(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue per order and customer.

    Two distinct counts in one aggregate make Spark triple its rows, so they are taken over
    these sums and not over the lines. An order may have several headers: it counts once.
    """
    return sales.groupBy(*keys, "order_id", "customer_id").agg(_revenue().alias("sum"))


def total_revenue(sales: DataFrame) -> DataFrame:
    return per_order(sales).agg(
        amount(F.sum("sum")).alias("total_revenue"),
        _orders().alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
    )


def _by_month(sales: DataFrame, *measures: Column) -> DataFrame:
    return sales.groupBy(F.year("date_key").alias("year"), F.month("date_key").alias("month")).agg(*measures)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    months = _by_month(sales, _revenue().alias("revenue"), _orders().alias("monthly_orders"))
    return months.select(
        "year", "month", month_name(F.make_date("year", "month", F.lit(1))).alias("month_name"),
        amount("revenue").alias("monthly_revenue"), "monthly_orders",
    ).orderBy("year", "month")


def month_over_month(sales: DataFrame) -> DataFrame:
    """Growth against the previous month that has sales."""
    # One row per month reaches the unpartitioned window.
    months = _by_month(sales, _revenue().alias("sum")).withColumn("prev", F.lag("sum").over(Window.orderBy("year", "month")))
    now, before = F.col("sum"), F.col("prev")
    return months.select(
        "year", "month", amount(now).alias("revenue"), amount(before).alias("prev_month_revenue"),
        ratio((now - before) * 100, before).alias("mom_growth_pct"),
    ).orderBy("year", "month")


def _product_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per product, summed before the names are joined."""
    sums = sales.groupBy("product_id").agg(_revenue().alias("sum"), F.sum("quantity").alias("units_sold"))
    return join_star(sums, products, "product_id", "inner", ["product_name", "category"])


def top_products(sales: DataFrame, products: DataFrame, n: int = 20, ascending: bool = False) -> DataFrame:
    revenue = F.asc("sum") if ascending else F.desc("sum")
    return top_k(_product_revenue(sales, products), [revenue, "product_id"], n).select(
        "product_id", "product_name", "category", amount("sum").alias("revenue"), "units_sold"
    )


def bottom_products(sales: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    return top_products(sales, products, n, ascending=True)


def category_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    sums = _product_revenue(sales, products).groupBy("category").agg(
        F.sum("sum").alias("sum"), F.sum("units_sold").alias("units_sold")
    )
    # One row per category reaches the unpartitioned window.
    whole = F.sum("sum").over(Window.partitionBy())
    return sums.select(
        "category", amount("sum").alias("revenue"), "units_sold",
        ratio(F.col("sum") * 100, whole).alias("pct_of_total_revenue"),
    ).orderBy(F.desc("revenue"), "category")


def regional_performance(sales: DataFrame) -> DataFrame:
    sums = per_order(sales, "store_region").groupBy("store_region").agg(
        F.sum("sum").alias("sum"), _orders().alias("orders"), F.count_distinct("customer_id").alias("customers")
    )
    return sums.select(
        "store_region", amount("sum").alias("revenue"), "orders", "customers",
        ratio(F.col("sum"), F.col("orders")).alias("avg_order_value"),
    ).orderBy(F.desc("revenue"), "store_region")


def lifetime_value(sales: DataFrame, customers: DataFrame, n: int = 25) -> DataFrame:
    sums = sales.groupBy("customer_id").agg(_revenue().alias("sum"), _orders().alias("total_orders"))
    named = join_star(sums, customers, "customer_id", "inner", ["name", "loyalty_tier"])
    return top_k(named, [F.desc("sum"), "customer_id"], n).select(
        "customer_id", "name", "loyalty_tier", amount("sum").alias("lifetime_value"), "total_orders"
    )


def _orders_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(_orders().alias("n_orders"))


def repeat_rate(sales: DataFrame) -> DataFrame:
    counts = _orders_per_customer(sales).agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(F.col("n_orders") > 1).alias("repeat_customers")
    )
    share = ratio(F.col("repeat_customers").cast("decimal(20,0)") * 100, F.col("total_customers"))
    return counts.withColumn("repeat_customer_rate_pct", share)


def order_value_by_channel(sales: DataFrame, with_total: bool = False) -> DataFrame:
    """Average order value per channel; `with_total` adds the overall row (channel null)."""
    grouped = sales.rollup("channel") if with_total else sales.groupBy("channel")
    sums = grouped.agg(_revenue().alias("sum"), _orders().alias("orders"))
    return sums.select(
        "channel", ratio(F.col("sum"), F.col("orders")).alias("avg_order_value"), "orders"
    ).orderBy(F.desc("avg_order_value"), "channel")


def tier_performance(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Per tier, customers without sales included; the fact is summed before the join."""
    sums = sales.groupBy("customer_id").agg(_revenue().alias("sum"))
    tiers = customers.select("customer_id", "loyalty_tier").join(sums, "customer_id", "left").groupBy("loyalty_tier").agg(
        F.count_distinct("customer_id").alias("customers"), F.sum("sum").alias("sum")
    )
    return tiers.select(
        "loyalty_tier", "customers", amount("sum").alias("revenue"),
        ratio(F.col("sum"), F.col("customers")).alias("revenue_per_customer"),
    ).orderBy(F.desc_nulls_last("revenue_per_customer"), "loyalty_tier")


def inactivity_buckets(sales: DataFrame) -> DataFrame:
    last = sales.groupBy("customer_id").agg(F.max("date_key").alias("last"))
    # The same aggregate again, so Spark reuses its shuffle and reads the fact once.
    newest = last.agg(F.max("last")).scalar()
    gaps = last.select(F.datediff(newest, F.col("last")).alias("days"))
    days = F.col("days")
    bucket = F.when(days <= 30, INACTIVITY[0]).when(days <= 90, INACTIVITY[1]).when(days <= 180, INACTIVITY[2])
    return (
        gaps.groupBy(bucket.otherwise(INACTIVITY[3]).alias("inactivity_bucket"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(place(F.col("inactivity_bucket"), INACTIVITY))
    )


def cumulative_revenue(sales: DataFrame) -> DataFrame:
    months = _by_month(sales, _revenue().alias("sum"))
    return months.select(
        "year", "month", amount("sum").alias("monthly_revenue"),
        amount(F.sum("sum").over(Window.orderBy("year", "month"))).alias("cumulative_revenue"),
    ).orderBy("year", "month")


def top_customers_per_region(sales: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers of rank 1..n by revenue in their region; ties share a rank."""
    sums = sales.groupBy("customer_id").agg(_revenue().alias("sum"))
    named = join_star(sums, customers, "customer_id", "inner", ["region", "name"])
    # The filter on the rank lets Spark keep n rows per region in each task before it shuffles.
    rank = F.rank().over(Window.partitionBy("region").orderBy(F.desc("sum")))
    return (
        named.withColumn("region_rank", rank)
        .where(F.col("region_rank") <= n)
        .select("region", "customer_id", "name", amount("sum").alias("revenue"), "region_rank")
        .orderBy("region", "region_rank", "customer_id")
    )


def order_count_buckets(sales: DataFrame) -> DataFrame:
    n = F.col("n_orders")
    bucket = F.when(n == 1, ORDER_COUNTS[0]).when(n.between(2, 3), ORDER_COUNTS[1]).when(n.between(4, 6), ORDER_COUNTS[2])
    return (
        _orders_per_customer(sales)
        .groupBy(bucket.otherwise(ORDER_COUNTS[3]).alias("frequency_bucket"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(place(F.col("frequency_bucket"), ORDER_COUNTS))
    )


def payment_methods(sales: DataFrame) -> DataFrame:
    sums = sales.groupBy("payment_method").agg(_revenue().alias("sum"), _orders().alias("orders"))
    return sums.select(
        "payment_method", "orders", ratio(F.col("sum"), F.col("orders")).alias("avg_order_value")
    ).orderBy(F.desc("orders"), "payment_method")


def discount_band(discount: Column) -> Column:
    return (
        F.when(discount == 0, DISCOUNTS[0]).when(discount <= F.lit("0.10").cast("decimal(5,4)"), DISCOUNTS[1])
        .when(discount <= F.lit("0.20").cast("decimal(5,4)"), DISCOUNTS[2]).otherwise(DISCOUNTS[3])
    )


def answers(sales: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """All seventeen by name, in order; nothing runs until a result is used."""
    return {
        "total_revenue": total_revenue(sales),
        "monthly_revenue": monthly_revenue(sales),
        "month_over_month": month_over_month(sales),
        "top_products": top_products(sales, products),
        "bottom_products": bottom_products(sales, products),
        "category_performance": category_performance(sales, products),
        "regional_performance": regional_performance(sales),
        "lifetime_value": lifetime_value(sales, customers),
        "repeat_rate": repeat_rate(sales),
        "order_value_by_channel": order_value_by_channel(sales),
        "tier_performance": tier_performance(customers, sales),
        "inactivity": inactivity_buckets(sales),
        "cumulative_revenue": cumulative_revenue(sales),
        "top_customers_per_region": top_customers_per_region(sales, customers),
        "order_frequency": order_count_buckets(sales),
        "payment_methods": payment_methods(sales),
        "discount_impact": discount_impact(sales),
    }


def discount_impact(items: DataFrame) -> DataFrame:
    """Lines and units per discount band, over the fact or any table of lines."""
    sums = items.groupBy(discount_band(F.col("discount")).alias("discount_band")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum("quantity").alias("units_sold"), F.count("quantity").alias("n")
    )
    return sums.select(
        "discount_band", "line_items", "units_sold",
        ratio(F.col("units_sold").cast("decimal(20,0)"), F.col("n")).alias("avg_qty_per_line"),
    ).orderBy(place(F.col("discount_band"), DISCOUNTS))

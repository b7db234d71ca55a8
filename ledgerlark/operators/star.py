"""The star schema: date dimension, line-grain sales and the constraint audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.text import day_name, month_name
from ledgerlark.operators.joins import join_star, orphans
from ledgerlark.session import stage

# The columns of the fact.
FACT_COLUMNS = [
    "order_id", "customer_id", "product_id", "date_key", "quantity", "unit_price", "discount",
    "line_total", "payment_method", "channel", "store_region",
]

HEADER_CONTEXT = ["customer_id", "order_date", "payment_method", "channel", "store_region"]


def date_dimension(orders: DataFrame, day: str = "order_date") -> DataFrame:
    """One row per calendar day between the first and the last order."""
    span = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    d = F.col("date_key")
    return span.select(F.explode(F.sequence("first", "last")).alias("date_key")).select(
        "date_key",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.day(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
    )


def sales_fact(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the context of their header; lines without a header are left out."""
    return fact_from_lines(join_star(items, orders, "order_id", "inner", HEADER_CONTEXT))


def fact_from_lines(lines: DataFrame) -> DataFrame:
    """The fact from lines that already carry `HEADER_CONTEXT`."""
    return lines.withColumnRenamed("order_date", "date_key").select(*FACT_COLUMNS)


def constraint_audit(
    customers: DataFrame, products: DataFrame, dates: DataFrame, sales: DataFrame
) -> DataFrame:
    """Violations per primary key, foreign key and not-null rule: (table, rule, violations)."""
    spark = sales.sparkSession

    def row(table: str, rule: str, counted: DataFrame) -> DataFrame:
        return counted.select(
            F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.col(counted.columns[0]).cast("long").alias("violations")
        )

    def repeated(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))

    keyed = [("dim_customer", customers, "customer_id"), ("dim_product", products, "product_id"), ("dim_date", dates, "date_key")]
    # One pass over the fact counts its rows per combination of keys that each check needs: the
    # grouping sets share one shuffle, and the checks read the small table written from it.
    keys = [key for _, _, key in keyed]
    combined = sales.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_set")
    )
    counts = stage(combined, "fact-keys")
    whole = (1 << len(keys)) - 1
    checks = []
    for i, (table, df, key) in enumerate(keyed):
        checks.append(row(table, f"primary key {key}", repeated(df, key)))
        own = counts.where(F.col("_set") == whole - (1 << (len(keys) - 1 - i))).select(key, "_rows")
        checks.append(row("fact_sales", f"foreign key {key}", orphans(own, df, key).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))))
    for table, df in [(t, d) for t, d, _ in keyed] + [("fact_sales", sales)]:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).unpivot([], df.columns, "c", "violations")
        checks.append(
            nulls.select(F.lit(table).alias("table"), F.concat(F.lit("not null "), "c").alias("rule"), F.col("violations").cast("long").alias("violations"))
        )
    return reduce(DataFrame.unionByName, checks)

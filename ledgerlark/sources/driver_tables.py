"""The given tables seen as customers, products, orders and order items.

Money is cast to DECIMAL before any arithmetic, so that sums do not depend on row order.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.functions.encode import encode
from ledgerlark.operators.star import sales_fact

REFERENCE_DATE = date(2001, 8, 1)
CUTOFF = date(2001, 5, 3)
OBSERVATION_END = date(2001, 8, 1)

# The loyalty tier that stands for each market segment.
TIERS = {
    "AUTOMOBILE": "Gold", "BUILDING": "Silver", "FURNITURE": "Bronze", "HOUSEHOLD": "Platinum",
}


class DriverTables:
    """Lazy views over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "n_name", "r_name"
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("customer_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                F.when(key % 25 == 0, "Other").when(key % 2 == 1, "Female").otherwise("Male").alias("gender"),
                ((key * 37) % 110).cast("int").alias("age"),
                F.col("n_name").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("region"),
                F.date_add(F.lit("1995-01-01").cast("date"), ((key * 13) % 2400).cast("int")).alias("signup_date"),
                encode(F.col("c_mktsegment"), TIERS, "Unknown").alias("loyalty_tier"),
                F.floor("c_acctbal").cast("int").alias("loyalty_points"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(10,2)")
        cost = F.round(price * F.lit("0.45").cast("decimal(3,2)"), 2).cast("decimal(10,2)")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("p_partkey") % 50 == 0, F.lit("-1").cast("decimal(10,2)")).otherwise(cost).alias("unit_cost"),
            price.alias("unit_price"),
        )

    @cached_property
    def headers(self) -> DataFrame:
        """Orders without the store region, for work that does not need the customer join."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.when(F.col("o_orderstatus") == "F", "In-Store").otherwise("Online").alias("channel"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        home = self.raw("customer").join(self.places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"), F.col("r_name").alias("store_region")
        )
        return self.headers.join(home, "customer_id", "left").select(*self.headers.columns, "store_region")

    @cached_property
    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        units = F.col("l_quantity").cast("int")
        discount = (F.col("l_discount").cast("decimal(5,4)") * F.lit(3).cast("decimal(1,0)")).cast("decimal(5,4)")
        total = F.round(price * units.cast("decimal(10,0)") * (F.lit(1).cast("decimal(1,0)") - discount), 2)
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            units.alias("quantity"),
            price.alias("unit_price"),
            discount.alias("discount"),
            total.cast("decimal(12,2)").alias("line_total"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return sales_fact(self.items, self.orders)

    @cached_property
    def sales_lean(self) -> DataFrame:
        """The fact without the store region, which costs a join to customers."""
        return sales_fact(self.items, self.headers.withColumn("store_region", F.lit(None).cast("string")))

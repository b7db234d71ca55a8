"""Wide extracts for BI tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.encode import band
from ledgerlark.functions.text import month_name
from ledgerlark.operators.colocated import Colocated, with_headers
from ledgerlark.operators.joins import join_star, left_join_suffixed
from ledgerlark.operators.star import date_dimension

# Risk bands of the customer extract, closed on the right.
RISK_EDGES = [-0.01, 0.3, 0.6, 1.0]
RISK_BANDS = ["Low", "Medium", "High"]

# The columns of the sales extract and of the header they need.
SALES_COLUMNS = [
    "order_id", "order_date", "order_year", "order_month", "order_month_name", "customer_id",
    "product_id", "product_name", "category", "subcategory", "brand", "quantity", "unit_price",
    "discount", "line_total", "gross_margin", "payment_method", "channel", "region",
]
HEADER_COLUMNS = ["customer_id", "order_date", "channel", "store_region", "payment_method"]


def risk_band(probability: Column) -> Column:
    return band(probability, RISK_EDGES, RISK_BANDS)


def sales_extract(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line with date parts and margin; unknown products keep their lines."""
    return extract_from_lines(join_star(items, orders, "order_id", "inner", HEADER_COLUMNS), products)


def extract_from_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The sales extract from lines that already carry `HEADER_COLUMNS`."""
    named = join_star(
        lines, products, "product_id", "left", ["product_name", "category", "subcategory", "brand", "unit_cost"]
    )
    margin = (
        (F.col("unit_price") - F.col("unit_cost")) * F.col("quantity").cast("decimal(10,0)")
        * (F.lit(1).cast("decimal(1,0)") - F.col("discount"))
    )
    return named.withColumns({
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_month_name": month_name(F.col("order_date")),
        "gross_margin": margin,
    }).withColumnRenamed("store_region", "region").select(*SALES_COLUMNS)


def sales_detail(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with header and product columns; lines without either are left out."""
    return detail_from_lines(join_star(items, orders, "order_id", "inner", HEADER_COLUMNS), products)


def detail_from_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The sales detail from lines that already carry `HEADER_COLUMNS`."""
    return join_star(lines, products, "product_id", "inner", ["product_name", "category", "subcategory", "brand"])


def _scored(customers: DataFrame, segments: DataFrame | None, predictions: DataFrame | None) -> DataFrame:
    """Add segment and probability; null columns where a table is not there yet."""
    if segments is None:
        joined = customers.withColumn("segment", F.lit(None).cast("string"))
    else:
        joined = customers.join(segments.select("customer_id", "segment"), "customer_id", "left")
    if predictions is None:
        return joined.withColumn("churn_probability", F.lit(None).cast("double"))
    return joined.join(predictions.select("customer_id", "churn_probability"), "customer_id", "left")


def customer_extract(
    customers: DataFrame, features: DataFrame, segments: DataFrame | None = None, predictions: DataFrame | None = None
) -> DataFrame:
    """Profile, features, segment, probability and risk band; one row per customer."""
    wide = left_join_suffixed(customers, features, "customer_id", suffix=None)
    return _scored(wide, segments, predictions).withColumn("churn_risk_band", risk_band(F.col("churn_probability")))


def customer_360(
    customers: DataFrame, features: DataFrame, segments: DataFrame | None = None, predictions: DataFrame | None = None
) -> DataFrame:
    """As the customer extract, but with the overlapping feature columns kept under `*_feat`."""
    wide = left_join_suffixed(customers, features, "customer_id", suffix="_feat")
    return _scored(wide, segments, predictions)


def extract_bundle(
    customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, features: DataFrame,
    segments: DataFrame | None = None, predictions: DataFrame | None = None, placed: Colocated | None = None,
) -> dict[str, DataFrame]:
    """Every extract by name; segments and predictions only where they exist.

    With orders and lines laid out together in `placed`, their joins need no shuffle.
    """
    if placed is None:
        lines = join_star(items, orders, "order_id", "inner", HEADER_COLUMNS)
    else:
        lines = with_headers(placed, "inner", HEADER_COLUMNS)
    bundle = {
        "sales_dashboard": extract_from_lines(lines, products),
        "customer_dashboard": customer_extract(customers, features, segments, predictions),
        "sales_detail": detail_from_lines(lines, products),
        "customer_360": customer_360(customers, features, segments, predictions),
        "customers": customers,
        "products": products,
        "orders": orders,
        "dim_date": date_dimension(orders),
    }
    if segments is not None:
        bundle["customer_segments"] = segments
    if predictions is not None:
        bundle["churn_predictions"] = predictions
    return bundle

"""Explicit schemas; no reader infers one."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

KEY = StringType()
PRICE = DecimalType(10, 2)
AMOUNT = DecimalType(12, 2)
SHARE = DecimalType(5, 4)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


CUSTOMERS = _struct(
    customer_id=KEY, name=StringType(), email=StringType(), gender=StringType(), age=IntegerType(),
    city=StringType(), state=StringType(), region=StringType(), signup_date=DateType(),
    loyalty_tier=StringType(), loyalty_points=IntegerType(),
)
PRODUCTS = _struct(
    product_id=KEY, product_name=StringType(), category=StringType(), subcategory=StringType(),
    brand=StringType(), unit_cost=PRICE, unit_price=PRICE,
)
ORDERS = _struct(
    order_id=KEY, customer_id=KEY, order_date=DateType(), total_amount=AMOUNT,
    payment_method=StringType(), channel=StringType(), store_region=StringType(),
)
ORDER_ITEMS = _struct(
    order_id=KEY, product_id=KEY, quantity=IntegerType(), unit_price=PRICE, discount=SHARE,
    line_total=AMOUNT,
)
ITEM = StructType([f for f in ORDER_ITEMS if f.name != "order_id"])
ORDER_DOCUMENTS = StructType([*ORDERS, StructField("items", ArrayType(ITEM))])
METRICS = _struct(
    model=StringType(), precision=DoubleType(), recall=DoubleType(), f1_score=DoubleType(),
    roc_auc=DoubleType(),
)
MODEL_RECORD = StructType([
    StructField("best_model", StringType()),
    StructField("logistic_regression", METRICS),
    StructField("random_forest", METRICS),
    StructField("random_forest_cv_roc_auc_mean", DoubleType()),
    StructField("random_forest_cv_roc_auc_std", DoubleType()),
    StructField("churn_feature_columns", ArrayType(StringType())),
])
EVENTS = _struct(
    event_id=LongType(), ts=TimestampNTZType(), user_id=LongType(), event_type=StringType(), value=DoubleType(), props=StringType(),
)


def as_text(schema: StructType, *names: str) -> StructType:
    """The same schema with the named columns read as text, for raw input still to be parsed."""
    return StructType(
        [StructField(f.name, StringType() if f.name in names else f.dataType) for f in schema]
    )


def with_keys(schema: StructType, dtype) -> StructType:
    """The same schema with every `*_id` column of another type."""
    return StructType(
        [StructField(f.name, dtype if f.name.endswith("_id") else f.dataType) for f in schema]
    )

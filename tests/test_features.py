from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import features as L

D = date.fromisoformat
AS_OF = date(2024, 3, 1)


@pytest.fixture(scope="module")
def data(spark):
    customers = spark.createDataFrame(
        [("C1", D("2023-01-01"), "Gold", 1000, "East", 30, "Female"), ("C2", D("2023-06-01"), "Silver", 500, "West", 40, "Male"),
         ("C3", D("2024-01-01"), "Bronze", 100, "North", 25, "Female")],
        "customer_id string, signup_date date, loyalty_tier string, loyalty_points int, region string, age int, gender string")
    orders = spark.createDataFrame(
        [("O1", "C1", D("2024-01-01"), Decimal(100)), ("O2", "C1", D("2024-02-01"), Decimal(50)),
         ("O3", "C2", D("2024-01-15"), Decimal(200)), ("O4", "C1", D("2024-06-01"), Decimal(75))],
        "order_id string, customer_id string, order_date date, total_amount decimal(12,2)")
    items = spark.createDataFrame(
        [("O1", "P1", 1, Decimal("0")), ("O2", "P2", 2, Decimal("0.1")), ("O3", "P1", 1, Decimal("0")), ("O4", "P3", 1, Decimal("0.05"))],
        "order_id string, product_id string, quantity int, discount decimal(5,4)")
    products = spark.createDataFrame([("P1", "Men"), ("P2", "Women"), ("P3", "Kids")], "product_id string, category string")
    return customers, orders, items, products


def by_id(df):
    return {r.customer_id: r for r in df.collect()}


def test_orders_after_the_date_do_not_count(data):
    c1 = by_id(L.build_rfm_features(data[0], data[1], AS_OF))["C1"]
    assert (c1.frequency, float(c1.monetary), c1.recency_days, c1.avg_order_value) == (2, 150.0, 29, 75.0)


def test_customer_without_orders(data):
    c3 = by_id(L.build_rfm_features(data[0], data[1], AS_OF))["C3"]
    assert (c3.frequency, float(c3.monetary), c3.recency_days, c3.avg_order_value) == (0, 0.0, 60, 0.0)


def test_signup_after_the_date_gives_recency_zero(data):
    c3 = by_id(L.build_rfm_features(data[0], data[1], date(2023, 12, 1)))["C3"]
    assert c3.recency_days == 0


def test_scores(data):
    got = by_id(L.add_rfm_scores(L.build_rfm_features(data[0], data[1], AS_OF)))
    assert {k: r.RFM_score for k, r in got.items()} == {"C1": "553", "C2": "335", "C3": "111"}


def test_single_customer_scores_one(data):
    one = data[0].where("customer_id = 'C1'")
    assert L.add_rfm_scores(L.build_rfm_features(one, data[1], AS_OF)).first().RFM_score == "111"


@pytest.mark.parametrize("n", [2, 4, 5, 11, 23, 50])
def test_scores_follow_the_pandas_quintiles(wide, n):
    rows = [(i, (i * 7) % 13, (i * 5) % 3, Decimal((i * 11) % 17)) for i in range(n)]
    rfm = wide.createDataFrame(rows, "customer_id int, recency_days int, frequency long, monetary decimal(12,2)")
    got = L.add_rfm_scores(rfm).toPandas().sort_values("customer_id").reset_index(drop=True)
    ranks = pd.DataFrame(rows, columns=["id", "r", "f", "m"]).astype(float).rank(method="first")
    want = {c: pd.qcut(ranks[c], 5, labels=False, duplicates="drop") + 1 for c in "rfm"}
    assert got.R_score.tolist() == (6 - want["r"]).tolist()
    assert got.F_score.tolist() == want["f"].tolist() and got.M_score.tolist() == want["m"].tolist()


def test_feature_table(data):
    got = by_id(L.build_customer_features(*data, AS_OF))
    c1, c2, c3 = got["C1"], got["C2"], got["C3"]
    assert set(c1.asDict()) == set(L.FEATURE_COLUMNS)
    assert (c1.customer_tenure_days, c1.total_items_purchased, c1.unique_products_purchased, c1.unique_categories_purchased) == (425, 3, 2, 2)
    assert c1.average_discount == pytest.approx(0.05) and c1.purchase_trend_ratio == 2.0 and c1.loyalty_tier_encoded == 2
    assert (c2.customer_tenure_days, c2.total_items_purchased, c2.average_discount, c2.loyalty_tier_encoded) == (274, 1, 0.0, 1)
    assert (c3.total_items_purchased, c3.unique_products_purchased, c3.average_discount, c3.purchase_trend_ratio) == (0, 0, 0.0, 1.0)
    assert all(v is not None for r in got.values() for v in r)


def test_unknown_products_count_as_products_but_not_as_categories(data, spark):
    customers, orders, items, products = data
    got = by_id(L.basket_stats(orders, items, products.where("product_id <> 'P2'"), AS_OF))["C1"]
    assert (got.unique_products_purchased, got.unique_categories_purchased) == (2, 1)


def test_trend_ratio_of_two_windows(data, spark):
    orders = spark.createDataFrame(
        [("A", "C1", D("2024-02-01"), Decimal(30)), ("B", "C1", D("2023-10-01"), Decimal(20)), ("C", "C2", D("2023-10-01"), Decimal(5)),
         ("D", "C1", D("2023-09-03"), Decimal(1000))],
        data[1].schema)
    got = by_id(L.order_stats(orders, AS_OF).withColumn("t", L.trend_ratio()))
    assert got["C1"].t == 1.5 and got["C2"].t == 0.0


@pytest.mark.parametrize("cutoff, days, want", [
    ("2024-02-15", 90, {"C1": 1, "C2": 1, "C3": 1}), ("2024-02-15", 120, {"C1": 0, "C2": 1, "C3": 1}), ("2023-12-01", 90, {"C1": 0, "C2": 0}),
])
def test_labels(data, cutoff, days, want):
    from datetime import timedelta

    got = L.build_churn_labels(data[1], data[0], D(cutoff), D(cutoff) + timedelta(days=days))
    assert {r.customer_id: r.churned for r in got.collect()} == want


def test_study_dates():
    assert L.study_dates(date(2026, 7, 1)) == (date(2026, 4, 2), date(2026, 7, 1))


def test_an_order_with_two_headers_counts_once(spark):
    from ledgerlark.plans import business, measures

    rows = [(1, "a", "N", "web", 10), (1, "b", "S", "web", 5), (1, "a", "N", "web", 1), (2, "b", "S", "shop", 7)]
    sales = spark.createDataFrame(rows, "order_id int, customer_id string, store_region string, channel string, line_total int")
    sales = sales.withColumn("line_total", F.col("line_total").cast("decimal(12,2)"))
    total = business.total_revenue(sales).first()
    assert (total.total_orders, total.total_customers, float(total.total_revenue)) == (2, 2, 23.0)
    regions = {r.store_region: (r.orders, r.customers) for r in business.regional_performance(sales).collect()}
    assert regions == {"N": (1, 1), "S": (2, 1)}
    cube = {(r.store_region, r.channel): (float(r.total_revenue), r.total_orders) for r in measures.slicer_cube(sales, ["store_region", "channel"]).collect()}
    assert cube == {
        ("N", "web"): (11.0, 1), ("S", "web"): (5.0, 1), ("S", "shop"): (7.0, 1), ("N", None): (11.0, 1), ("S", None): (12.0, 2),
        (None, "web"): (16.0, 1), (None, "shop"): (7.0, 1), (None, None): (23.0, 2),
    }

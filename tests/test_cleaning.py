from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerlark import schemas
from ledgerlark.operators import cleaning as C

RAW_CUSTOMERS = schemas.as_text(schemas.CUSTOMERS, "signup_date")
RAW_ORDERS = schemas.as_text(schemas.ORDERS, "order_date")


def customer(key, **changes):
    row = dict(customer_id=key, name="A", email="a@x.com", gender="Male", age=35, city="NYC", state="NY", region="East",
               signup_date="2023-01-01", loyalty_tier="Gold", loyalty_points=100)
    return {**row, **changes}


def product(key, cost, price, **changes):
    row = dict(product_id=key, product_name="Shirt", category="Men", subcategory="Shirts", brand="B",
               unit_cost=None if cost is None else Decimal(cost), unit_price=None if price is None else Decimal(price))
    return {**row, **changes}


def order(key, customer_id="C1", day="2024-01-01", total="20.0", **changes):
    row = dict(order_id=key, customer_id=customer_id, order_date=day, total_amount=None if total is None else Decimal(total),
               payment_method="Card", channel="Online", store_region="East")
    return {**row, **changes}


def item(order_id, product_id="P1", quantity=2, line="20.0", discount="0.0"):
    return dict(order_id=order_id, product_id=product_id, quantity=quantity, unit_price=Decimal("10"),
                discount=None if discount is None else Decimal(discount), line_total=None if line is None else Decimal(line))


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def arriving(spark, rows, schema):
    """A table with the order of its rows in `seq`."""
    wide = StructType([*schema.fields, StructField("seq", IntegerType())])
    return frame(spark, [{**r, "seq": i} for i, r in enumerate(rows)], wide)


def customers(spark, *rows):
    return C.clean_customers(arriving(spark, rows, RAW_CUSTOMERS), ["seq"])


def counts(cleaned):
    return {r["check"]: r["issue_count"] for r in cleaned.report.collect()}


def orders_and_items(spark, orders, items, known=("C1",), sold=("P1",)):
    return C.clean_orders_and_items(
        arriving(spark, orders, RAW_ORDERS), frame(spark, items, schemas.ORDER_ITEMS),
        spark.createDataFrame([(k,) for k in known], "customer_id string"), spark.createDataFrame([(p,) for p in sold], "product_id string"), ["seq"])


def test_duplicate_customers_are_removed(spark):
    got = customers(spark, customer("C1"), customer("C1"), customer("C2"))
    assert sorted(r.customer_id for r in got.rows.collect()) == ["C1", "C2"]
    assert counts(got)["duplicate_customer_id"] == 1


def test_arrival_decides_which_copy_stays(spark):
    schema = StructType([*RAW_CUSTOMERS.fields, StructField("seq", IntegerType())])
    rows = [{**customer("C1", name="late"), "seq": 2}, {**customer("C1", name="zoe"), "seq": 1}]
    got = C.clean_customers(frame(spark, rows, schema), ["seq"]).rows.collect()
    assert [r.name for r in got] == ["zoe"]


def test_null_ids_are_equal_copies_then_dropped(spark):
    got = customers(spark, customer(None), customer(None, name="B"), customer("C1"))
    assert counts(got)["duplicate_customer_id"] == 1 and counts(got)["missing_customer_id"] == 1
    assert got.rows.count() == 1


def test_invalid_ages_become_the_truncated_median(spark):
    got = customers(spark, customer("C1", age=200), customer("C2", age=-5), customer("C3", age=35), customer("C4", age=40), customer("C5", age=None))
    ages = {r.customer_id: r.age for r in got.rows.collect()}
    assert ages == {"C1": 37, "C2": 37, "C3": 35, "C4": 40, "C5": 37}
    row = got.report.where("check = 'invalid_age'").first()
    assert row.issue_count == 3 and row.action_taken == "replaced with median age (38)"


def test_edge_ages_are_valid(spark):
    got = customers(spark, customer("C1", age=16), customer("C2", age=100), customer("C3", age=15), customer("C4", age=101))
    assert counts(got)["invalid_age"] == 2


def test_negative_points_are_zero_and_null_points_stay(spark):
    got = customers(spark, customer("C1", loyalty_points=-50), customer("C2", loyalty_points=None))
    assert {r.customer_id: r.loyalty_points for r in got.rows.collect()} == {"C1": 0, "C2": None}
    assert counts(got)["negative_loyalty_points"] == 1


def test_missing_text_and_tiers(spark):
    got = customers(spark, customer("C1", name=None, loyalty_tier=None), customer("C2", loyalty_tier="Diamond", gender=None))
    rows = {r.customer_id: r for r in got.rows.collect()}
    assert rows["C1"].name == "Unknown" and rows["C1"].loyalty_tier == "Bronze" and rows["C2"].loyalty_tier == "Bronze"
    assert rows["C2"].gender is None
    found = counts(got)
    # A null tier is counted by both rules.
    assert found["missing_loyalty_tier"] == 1 and found["invalid_loyalty_tier"] == 2 and found["missing_name"] == 1
    actions = {r["check"]: r.action_taken for r in got.report.collect()}
    assert actions["missing_name"] == "filled with 'Unknown'" and actions["missing_email"] == "none found"


def test_bad_signup_dates_drop_rows_before_the_tier_rule(spark):
    got = customers(spark, customer("C1", signup_date="soon", loyalty_tier="X"), customer("C2"))
    assert [r.signup_date for r in got.rows.collect()] == [date(2023, 1, 1)]
    assert counts(got)["invalid_signup_date"] == 1 and counts(got)["invalid_loyalty_tier"] == 0


def test_product_prices_and_costs(spark):
    rows = [product("P1", "-5", "20"), product("P2", "100", "50"), product("P3", "1", None), product("P4", "1", "0"), product("P4", "2", "9"), product(None, "1", "2")]
    got = C.clean_products(arriving(spark, rows, schemas.PRODUCTS), ["seq"])
    found = {r.product_id: (float(r.unit_cost), float(r.unit_price)) for r in got.rows.collect()}
    assert found["P1"] == (12.0, 20.0) and found["P2"] == (30.0, 50.0)
    assert found["P3"] == (1.0, 35.0) and found["P4"] == (1.0, 35.0)
    assert counts(got) == {"duplicate_product_id": 1, "missing_product_id": 1, "invalid_unit_price": 2, "invalid_unit_cost": 2}
    assert "(35.00)" in got.report.where("check = 'invalid_unit_price'").first().action_taken


def test_header_total_follows_its_lines(spark):
    o, _ = orders_and_items(spark, [order("O1", total="999.0")], [item("O1")])
    assert float(o.rows.first().total_amount) == 20.0


@pytest.mark.parametrize("total, kept", [("21.00", 21.0), ("21.01", 20.0), ("19.00", 19.0)])
def test_header_total_within_tolerance_stays(spark, total, kept):
    o, _ = orders_and_items(spark, [order("O1", total=total)], [item("O1")])
    assert float(o.rows.first().total_amount) == kept


def test_orphans_are_dropped(spark):
    o, i = orders_and_items(spark, [order("O1"), order("O2", "UNKNOWN", total="15"), order("O3", None)],
                            [item("O1"), item("O2"), item("O1", "PX"), item("O9")])
    assert [r.order_id for r in o.rows.collect()] == ["O1"] and [r.order_id for r in i.rows.collect()] == ["O1"]
    assert counts(o)["orphan_customer_reference"] == 2
    assert counts(i)["orphan_order_reference"] == 2 and counts(i)["orphan_product_reference"] == 1


def test_negative_quantity_empties_the_order(spark):
    o, i = orders_and_items(spark, [order("O1", total="0.0")], [item("O1", quantity=-3, line="-30.0")])
    assert o.rows.count() == 0 and i.rows.count() == 0
    assert counts(o)["orders_with_no_valid_items"] == 1 and counts(i)["invalid_quantity"] == 1
    assert counts(i)["invalid_line_total"] == 0


def test_order_rules_count_in_sequence(spark):
    rows = [order("O1"), order("O1", day="2024-01-02"), order("O2", "X", day="bad"), order("O3", day="2024-02-30"), order("O4", total="-1"), order("O5", total=None)]
    o, _ = orders_and_items(spark, rows, [item("O1"), item("O5")])
    found = counts(o)
    assert found["duplicate_order_id"] == 1 and found["orphan_customer_reference"] == 1
    assert found["invalid_order_date"] == 1 and found["negative_total_amount"] == 1
    assert [(r.order_id, r.order_date) for r in o.rows.collect()] == [("O1", date(2024, 1, 1))]


def test_item_rules(spark):
    rows = [item("O1", discount="-0.1"), item("O1", discount="1.5"), item("O1", discount=None), item("O1", line=None), item("O1", line="0"), item("O1", quantity=None)]
    o, i = orders_and_items(spark, [order("O1")], rows)
    got = sorted((-1 if r.discount is None else float(r.discount)) for r in i.rows.collect())
    assert got == [-1, 0.0, 0.0, 0.9]
    found = counts(i)
    assert found["invalid_discount_range"] == 2 and found["invalid_line_total"] == 1 and found["invalid_quantity"] == 1
    # Lines 20 + 20 + 20 + 0.
    assert counts(o)["total_amount_mismatch_vs_line_items"] == 1 and float(o.rows.first().total_amount) == 60.0


def test_report_has_27_rows_in_order(spark):
    got = C.clean_tables(
        frame(spark, [customer("C1")], RAW_CUSTOMERS), frame(spark, [product("P1", "5", "20")], schemas.PRODUCTS),
        frame(spark, [order("O1")], RAW_ORDERS), frame(spark, [item("O1")], schemas.ORDER_ITEMS))
    rows = got.report.collect()
    assert [r.seq for r in rows] == list(range(1, 28)) and sum(r.issue_count for r in rows) == 0
    assert C.total_issues(got.report).first().total_issues == 0
    assert [r.dataset for r in rows].count("order_items") == 5


def test_copies_without_an_order_of_arrival_are_refused(spark):
    with pytest.raises(ValueError, match="customer_id has copies"):
        C.clean_customers(frame(spark, [customer("C1"), customer("C1", name="z")], RAW_CUSTOMERS))
    with pytest.raises(ValueError, match="product_id has copies"):
        C.clean_products(frame(spark, [product("P1", "1", "2")] * 2, schemas.PRODUCTS))
    known = spark.createDataFrame([("C1",)], "customer_id string"), spark.createDataFrame([("P1",)], "product_id string")
    with pytest.raises(ValueError, match="order_id has copies"):
        C.clean_orders_and_items(frame(spark, [order("O1")] * 2, RAW_ORDERS), frame(spark, [item("O1")], schemas.ORDER_ITEMS), *known)
    assert C.clean_customers(frame(spark, [customer(None), customer(None), customer("C1")], RAW_CUSTOMERS)).rows.count() == 1


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_dates_of_every_kind_keep_their_rows(spark, kind):
    plain = frame(spark, [order("O1"), order("O2", day="2024-02-29"), order("O3", day=None)], RAW_ORDERS)
    known = spark.createDataFrame([("C1",)], "customer_id string"), spark.createDataFrame([("P1",)], "product_id string")
    typed = plain.withColumn("order_date", F.col("order_date").cast(kind))
    o, _ = C.clean_orders_and_items(typed, frame(spark, [item("O1"), item("O2")], schemas.ORDER_ITEMS), *known)
    assert sorted(r.order_date for r in o.rows.collect()) == [date(2024, 1, 1), date(2024, 2, 29)]
    assert counts(o)["invalid_order_date"] == 1


def test_text_of_dates_and_times(spark):
    from ledgerlark.functions.text import parse_date

    texts = ["2024-01-05", "2024-01-05 00:00:00", "2024-01-06T10:00:00", "2024-01-06T23:59:59.123456", "soon", "12:30", "2024-02-30", "2024-02-30 10:00:00", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date(F.col("t"))).collect()]
    assert got == [date(2024, 1, 5)] * 2 + [date(2024, 1, 6)] * 2 + [None] * 6

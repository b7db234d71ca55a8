from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.operators.features import order_stats
from ledgerlark.plans import business
from ledgerlark.sources import tables as io
from ledgerlark.streaming import upserts

DOCUMENTS = [
    {"_id": "x1", "order_id": "O1", "customer_id": "C1", "order_date": "2024-01-01", "total_amount": 30, "payment_method": "Card",
     "channel": "Online", "store_region": "East", "items": [
         {"product_id": "P1", "quantity": 1, "unit_price": 10, "discount": 0, "line_total": 10},
         {"product_id": "P2", "quantity": 2, "unit_price": 10, "discount": 0, "line_total": 20}]},
    {"_id": "x2", "order_id": "O2", "customer_id": "C1", "order_date": "2024-01-02", "total_amount": 0, "payment_method": "Card",
     "channel": "Online", "store_region": "East", "items": []},
]


def test_documents_flatten_to_headers_and_items(spark, tmp_path):
    import json

    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in DOCUMENTS))
    docs = io.read_documents(spark, str(tmp_path))
    assert "_id" not in docs.columns
    headers, items = io.flatten_orders(docs)
    assert headers.count() == 2 and "items" not in headers.columns
    assert {(r.order_id, r.product_id, r.quantity) for r in items.collect()} == {("O1", "P1", 1), ("O1", "P2", 2)}


def test_documents_keep_fields_of_any_shape(spark, tmp_path):
    import json

    more = [{**DOCUMENTS[0], "gift": {"to": "Ann", "notes": ["a", 2]}, "rank": 7}, {**DOCUMENTS[1], "rank": "high"}, DOCUMENTS[0]]
    (tmp_path / "docs.json").write_text("\n".join([*map(json.dumps, more), "no json"]))
    docs = io.read_whole_documents(spark, str(tmp_path))
    assert docs.columns == [*schemas.ORDER_DOCUMENTS.names, "others"]
    rows = docs.selectExpr(
        "order_id", "size(items) AS n", "array_sort(map_keys(others)) AS names", "try_variant_get(others['gift'], '$.notes[1]', 'int') AS note",
        "try_variant_get(others['rank'], '$', 'string') AS rank").collect()
    assert [(r.order_id, r.n, r.names, r.note, r["rank"]) for r in rows] == [
        ("O1", 2, ["gift", "rank"], 2, "7"), ("O2", 0, ["rank"], None, "high"), ("O1", 2, None, None, None), (None, -1 if rows[3].n == -1 else None, None, None, None)]


def test_csv_lines_that_do_not_fit_are_kept_as_text(spark, tmp_path):
    good = ["O1,C1,2024-02-28,1.5,a,b,c", "O2,,2024-02-28,,a,b,c"]
    bad = ["O3,C1,2024-02-28", "O4,C1,2024-02-28,2,a,b,c,more,fields", "O5,C1,2024-02-28,dear,a,b,c", "O6,C1,no day,1,a,b,c"]
    header = "order_id,customer_id,order_date,total_amount,payment_method,channel,store_region"
    (tmp_path / "a.csv").write_text("\n".join([header, good[0], *bad, good[1]]))
    rows, rejects = io.read_csv_with_rejects(spark, str(tmp_path), schemas.ORDERS)
    assert sorted(r.order_id for r in rows.collect()) == ["O1", "O2"] and rows.columns == schemas.ORDERS.names
    assert sorted(r.line for r in rejects.collect()) == sorted(bad)
    assert rows.count() == 2 and rejects.count() == 4


def test_missing_inputs_are_all_named_before_any_job(spark, tmp_path):
    sources = {
        "customers": io.Source(f"{tmp_path}/c", schemas.CUSTOMERS, "ingest"), "orders": io.Source(f"{tmp_path}/o", schemas.ORDERS, "cleaning"),
        "segments": io.Source(f"{tmp_path}/s", schemas.CUSTOMERS, "segmentation", optional=True)}
    with pytest.raises(FileNotFoundError) as error:
        io.load(spark, sources)
    text = str(error.value)
    assert "customers" in text and "orders" in text and "ingest, cleaning" in text and "segments" not in text


def test_bad_dates_in_csv_become_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,customer_id,order_date,total_amount,payment_method,channel,store_region\nO1,C1,2024-02-30,1.5,a,b,c\nO2,C1,2024-02-28,2,a,b,c\n")
    rows = {r.order_id: r.order_date for r in io.read_csv_parsing_dates(spark, str(tmp_path), schemas.ORDERS).collect()}
    assert rows == {"O1": None, "O2": date(2024, 2, 28)}


def test_fallback_location(spark, tmp_path):
    record = spark.createDataFrame([("m", 0.5, 0.5, 0.5, 0.5)], schemas.METRICS)
    io.write_json(record, f"{tmp_path}/second")
    assert io.read_with_fallback(spark, [f"{tmp_path}/first", f"{tmp_path}/second"], schemas.METRICS).first().model == "m"
    assert io.read_with_fallback(spark, [f"{tmp_path}/first"], schemas.METRICS) is None


def test_upsert_sets_keeps_and_inserts(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, keep string")
    updates = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("c", None, 1), ("b", None, 1)], "k string, n int, seq int")
    got = {r.k: (r.n, r.keep) for r in io.upsert(target, updates, "k", ["seq"]).collect()}
    assert got == {"a": (6, "x"), "b": (None, "y"), "c": (None, None)}


def test_partial_upsert_merges_fields(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, t string")
    updates = spark.createDataFrame([("a", 5, None, 1), ("a", None, "z", 2), ("a", 4, None, 0), ("c", None, "w", 1)], "k string, n int, t string, seq int")
    got = {r.k: (r.n, r.t) for r in io.upsert(target, updates, "k", ["seq"], partial=True).collect()}
    assert got == {"a": (5, "z"), "b": (2, "y"), "c": (None, "w")}


def test_date_filter_and_columns_reach_the_scan(spark, tmp_path):
    orders = spark.createDataFrame(
        [("O1", "C1", date(2024, 1, 5), Decimal(1), "Card", "Online", "East")], schemas.ORDERS)
    io.write_parquet(orders, f"{tmp_path}/orders")
    stats = order_stats(io.read_parquet(spark, f"{tmp_path}/orders", schemas.ORDERS), date(2024, 3, 1))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(order_date,2024-03-01)" in plan
    assert "payment_method" not in plan and plan.count("Exchange") == 1


def test_star_is_replaced_whole_and_prunes_by_month(spark, tmp_path):
    folder = f"{tmp_path}/star"
    sales = spark.createDataFrame([("O1", date(2024, 1, 5), Decimal(1)), ("O2", date(2024, 2, 5), Decimal(2))], "order_id string, date_key date, line_total decimal(12,2)")
    for _ in range(2):
        io.write_star(spark, folder, {"dim_product": spark.createDataFrame([("P1",)], "product_id string")}, sales)
    back = io.read_star(spark, folder, "fact_sales")
    assert back.count() == 2 and not io.path_exists(spark, f"{folder}.next")
    plan = back.where("year = 2024 AND month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_row_counts_and_empty(spark):
    rows = {r.source: (r.rows, r.needs_data) for r in io.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert rows == {"a": (3, False), "b": (0, True)}
    assert io.is_empty(spark.range(0)) and not io.is_empty(spark.range(1))


def test_stream_of_upserts(spark, tmp_path):
    source, target, check = f"{tmp_path}/in", f"{tmp_path}/target", f"{tmp_path}/check"
    schema = "k long, name string, seq int"
    upserts.write_target(spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("name"), F.lit("kept").alias("note")), target, "k", 8)
    spark.createDataFrame([(1, "n1", 1), (1, "n2", 2), (200, "new", 1)], schema).write.parquet(source)

    def run():
        upserts.upsert_stream(spark.readStream.schema(schema).parquet(source), target, "k", ["seq"], check, buckets=8).awaitTermination()
        return {r.k: (r.name, r.note) for r in upserts.read_target(spark, target).collect()}

    first = run()
    assert len(first) == 101 and first[1] == ("n2", "kept") and first[200] == ("new", None) and first[50] == ("old", "kept")
    # A replayed batch changes nothing; a new file is added to what is there.
    upserts.apply_batch(spark.read.schema(schema).parquet(source), target, "k", ["seq"], 8)
    spark.createDataFrame([(50, "n3", 1)], schema).write.mode("append").parquet(source)
    assert run() == {**first, 50: ("n3", "kept")}


def test_all_questions_have_an_answer(spark):
    sales = spark.createDataFrame(
        [("O1", "C1", "P1", date(2024, 1, 5), 1, Decimal("0.1"), Decimal(9), "Card", "Online", "East"),
         ("O2", "C1", "P1", date(2024, 3, 5), 2, Decimal(0), Decimal(20), "Cash", "Online", "East")],
        "order_id string, customer_id string, product_id string, date_key date, quantity int, discount decimal(5,4), "
        "line_total decimal(12,2), payment_method string, channel string, store_region string")
    customers = spark.createDataFrame([("C1", "A", "Gold", "East"), ("C2", "B", "Gold", "East")], "customer_id string, name string, loyalty_tier string, region string")
    products = spark.createDataFrame([("P1", "Shirt", "Men")], "product_id string, product_name string, category string")
    got = {name: df.collect() for name, df in business.answers(sales, customers, products).items()}
    assert len(got) == 17
    assert got["month_over_month"][1].mom_growth_pct == 122.22
    assert got["tier_performance"][0].revenue_per_customer == 14.5
    assert got["repeat_rate"][0].repeat_customer_rate_pct == 100.0
    assert got["order_value_by_channel"][0].avg_order_value == 14.5


def test_a_failed_star_load_leaves_the_old_one(spark, tmp_path):
    folder = f"{tmp_path}/star"
    sales = spark.createDataFrame([("O1", date(2024, 1, 5), Decimal(1))], "order_id string, date_key date, line_total decimal(12,2)")
    for n in range(1, 4):
        io.write_star(spark, folder, {"dim_product": spark.range(n)}, sales)
    with pytest.raises(Exception, match="raise_error|USER_RAISED"):
        io.write_star(spark, folder, {"dim_product": spark.range(9).select(F.raise_error(F.lit("broken")))}, sales)
    assert io.read_star(spark, folder, "dim_product").count() == 3
    with pytest.raises(FileNotFoundError):
        io.read_star(spark, f"{tmp_path}/nowhere", "dim_product")


def test_staged_tables_of_a_scope_go_also_on_failure(spark):
    from ledgerlark import session

    paths = []
    with pytest.raises(KeyError), session.staging_scope(spark):
        session.stage(spark.range(3), "scoped")
        session.in_threads(spark, lambda n: session.stage(spark.range(n), "scoped").count(), range(3), 2)
        paths += session._scope.get()
        work = session.Staging(spark, "scoped")
        work.table(spark.range(2), "a")
        paths.append(work.root)
        raise KeyError
    assert len(paths) == 5 and not any(io.path_exists(spark, p) for p in paths)
    with session.Staging(spark, "scoped") as work:
        assert work.table(spark.range(2), "a").count() == 2
    assert not io.path_exists(spark, work.root) and work.root not in session._staged

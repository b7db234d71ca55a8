"""Joins of orders and lines laid out together: rows, plans and hot orders."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import colocated as L


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def frames(spark, n=3000):
    orders = spark.range(200).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"), F.lit("x").alias("channel"))
    orders = orders.union(spark.sql("SELECT CAST(NULL AS BIGINT), CAST(3 AS BIGINT), 'none'"))
    # A third of all lines on order 5, some on no known order and some on none.
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") * 7919 % 230)
    lines = spark.range(n).select(key.cast("long").alias("order_id"), F.col("id").alias("line"), (F.col("id") % 11).alias("amount"))
    return orders, lines


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_give_the_rows_of_a_plain_join(spark, how):
    orders, lines = frames(spark)
    placed = L.colocate(orders, lines, buckets=6)
    assert rows(L.with_headers(placed, how)) == rows(lines.join(orders, "order_id", how))
    if how in ("inner", "left"):
        want = lines.join(orders.select("order_id", "channel"), "order_id", how)
        assert rows(L.with_headers(placed, how, ["channel"])) == rows(want)


def test_sums_give_the_rows_of_a_plain_join(spark):
    orders, lines = frames(spark)
    placed = L.colocate(orders, lines, buckets=6)
    sums = lines.groupBy("order_id").agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))
    got = L.with_sums(placed, total=F.sum("amount"), n=F.count(F.lit(1)))
    assert rows(got) == rows(orders.join(sums, "order_id", "left"))


def test_no_side_is_shuffled(unbroadcast):
    orders, lines = frames(unbroadcast)
    placed = L.colocate(orders, lines, buckets=6)
    joined = plan(L.with_headers(placed))
    assert "SortMergeJoin" in joined and "Exchange hashpartitioning" not in joined
    cold = plan(placed.headers.join(placed.lines.groupBy("order_id").agg(F.sum("amount")).hint("merge"), "order_id", "left"))
    assert "SortMergeJoin" in cold and "Exchange hashpartitioning" not in cold
    plain = plan(lines.join(orders, "order_id"))
    assert plain.count("Exchange hashpartitioning") >= 2


def test_a_hot_order_is_spread_and_few_are_hot(spark):
    orders, lines = frames(spark, 6000)
    placed = L.colocate(orders, lines, buckets=6)
    hot = [r.order_id for r in placed.hot_headers.collect()]
    assert 5 in hot and len(hot) < L.HOT * 6
    parts = placed.hot_lines.where("order_id = 5").groupBy(F.input_file_name()).count().collect()
    assert len(parts) == 6 and max(r["count"] for r in parts) < 2 * min(r["count"] for r in parts)
    each = [r["count"] for r in placed.lines.groupBy(F.input_file_name()).count().collect()]
    assert max(each) < 6000 / 6


def test_empty_tables_and_repeated_headers(spark):
    orders, lines = frames(spark, 300)
    nothing = L.colocate(orders, lines.limit(0), buckets=3)
    assert rows(L.with_headers(nothing)) == []
    assert len(rows(L.with_sums(nothing, n=F.count(F.lit(1))))) == 201
    assert len(rows(L.with_headers(L.colocate(orders.limit(0), lines, buckets=3), "left"))) == 300
    with pytest.raises(ValueError, match="one row per order_id"):
        L.colocate(orders.union(orders), lines, buckets=3)
    with pytest.raises(ValueError, match="no such join"):
        L.with_headers(nothing, "right")


def test_the_catalog_keeps_no_entry(spark):
    L.colocate(*frames(spark, 100), buckets=2)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerlark_")] == []

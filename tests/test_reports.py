"""Snapshots compared by ranges."""

import random

from ledgerlark.plans import reports


def test_migration_by_ranges_equals_the_full_join(spark):
    r = random.Random(1)
    before = [(i, r.choice(["a", "b", "c", None])) for i in range(600)] + [(None, "a"), (None, "b")]
    after = [(i, s) for i, s in before if i != 17]
    after = [(i, "c" if i in (5, 6, 300) else s) for i, s in after] + [(900, "a")]
    x, y = (spark.createDataFrame(rows, "customer_id long, segment string") for rows in (before, after))
    want = sorted(map(tuple, reports.segment_migration(x, y).collect()), key=str)
    for ranges in (1, 50, 4096):
        got = reports.segment_migration_by_ranges(x.repartition(3), y, ranges)
        assert sorted(map(tuple, got.collect()), key=str) == want
    empty = x.limit(0)
    assert reports.segment_migration_by_ranges(empty, empty).count() == 0
    assert reports.segment_migration_by_ranges(x, x).where("from_segment <> to_segment").count() == 0


def test_equal_ranges_are_not_joined(spark, tmp_path):
    spark.range(5000).selectExpr("id AS customer_id", "CAST(id % 3 AS STRING) AS segment").write.parquet(f"{tmp_path}/before")
    before = spark.read.parquet(f"{tmp_path}/before")
    before.selectExpr("customer_id", "CASE WHEN customer_id = 77 THEN 'new' ELSE segment END AS segment").write.parquet(f"{tmp_path}/after")
    found = reports.segment_migration_by_ranges(before, spark.read.parquet(f"{tmp_path}/after"), 1000)
    rows = {(r.from_segment, r.to_segment): r.customers for r in found.collect()}
    assert rows == {("0", "0"): 1667, ("1", "1"): 1667, ("2", "2"): 1665, ("2", "new"): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.count("LeftAnti") == 1

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import aggregates as A, joins as J, ranking as R
from ledgerlark.operators.churn import stratified_split


def rows(wide, n=2000):
    # A third of all rows share one value.
    return wide.range(n).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 7919 % 101).cast("int").alias("v"), (F.col("id") % 2).alias("g"))


def test_global_rank_equals_one_sorted_list_over_several_partitions(wide):
    df = rows(wide)
    got = R.global_rank(df, ["v", "id"])
    data = sorted((r.v, r.id) for r in df.collect())
    assert {r.id: r["rank"] for r in got.collect()} == {key: i + 1 for i, (_, key) in enumerate(data)}
    parts = R._laid_out(df, ["v", "id"], "test").select("_part").distinct().count()
    assert parts > 1


def test_rank_within_groups_and_descending(wide):
    df = rows(wide)
    got = {r.id: r["rank"] for r in R.global_rank(df, [F.desc("v"), "id"], within=["g"]).collect()}
    for g in (0, 1):
        data = sorted((-r.v, r.id) for r in df.where(F.col("g") == g).collect())
        assert all(got[key] == i + 1 for i, (_, key) in enumerate(data))


def test_running_total(wide):
    df = rows(wide)
    got = {r.id: r.running for r in R.running_total(df, ["v", "id"], "v").collect()}
    data = sorted((r.v, r.id) for r in df.collect())
    sums = np.cumsum([v for v, _ in data])
    assert got == {key: s for (_, key), s in zip(data, sums, strict=True)}


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1001])
def test_exact_quantiles(wide, n):
    df = rows(wide, n).withColumn("w", (F.col("v") * 1.5).cast("decimal(10,2)"))
    got = {(r.column, r.q): r.value for r in R.exact_quantiles(df, ["v", "w"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    data = df.toPandas()
    for c in ("v", "w"):
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert got[c, q] == pytest.approx(np.quantile(data[c].astype(float), q))


@pytest.mark.parametrize("kind", ["even", "ties", "constant", "wide"])
def test_quantiles_from_narrowed_brackets(wide, kind):
    """So few values to a bracket that it is narrowed several times."""
    rng = np.random.default_rng(7)
    x = {
        "even": rng.normal(size=60_000), "ties": np.floor(rng.exponential(3, 60_000)), "constant": np.full(5000, 2.5),
        "wide": np.concatenate([rng.normal(size=30_000) * 1e200, np.zeros(9000), [-np.inf, np.inf]]),
    }[kind]
    df = wide.createDataFrame([(float(v), int(i)) for i, v in enumerate(x)], "x double, y long").repartition(7)
    wanted = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    got = {(r["column"], r.q): (r.n, r.value) for r in R.exact_quantiles(df, ["x", "y"], wanted, rows=100).collect()}
    for q in wanted:
        assert got["y", q] == (len(x), pytest.approx(np.quantile(np.arange(len(x)), q)))
        spot = (len(x) - 1) * q
        low, high = np.sort(x)[[int(np.floor(spot)), int(np.ceil(spot))]]
        want = low if low == high else low + (high - low) * (spot % 1)
        assert got["x", q][1] == (want if np.isinf(want) else pytest.approx(want, rel=1e-12))


def test_quantiles_sort_no_more_than_their_brackets(wide):
    df = wide.range(300_000).selectExpr("CAST(id * 7919 % 300007 AS DOUBLE) AS x")
    made = R.exact_quantiles(df, ["x"], [0.5], rows=5000)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and made.first().value == np.median(np.arange(300_000) * 7919 % 300007)


def test_median_of_nothing_is_null(wide):
    assert R.exact_median(rows(wide).where("id < 0"), "v").first().median is None


def test_keep_first(wide):
    df = wide.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 2, "w"), ("b", 1, "q")], "k string, seq int, t string")
    got = {(r.k, r.seq, r.t) for r in R.keep_first(df, "k", ["seq"]).collect()}
    assert got == {("a", 1, "y"), (None, 2, "w"), ("b", 1, "q")}


def test_keep_first_combines_before_the_shuffle(wide):
    plan = R.keep_first(rows(wide), "v", ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "partial_min" in before and "Window" not in plan


def test_quantile_score_of_one_row(wide):
    got = wide.range(1).select(R.quantile_score(F.lit(1), F.lit(1)).alias("a"), R.quantile_score(F.lit(1), F.lit(1), ascending=False).alias("d")).first()
    assert (got.a, got.d) == (1, 1)


def test_hot_key_join_is_split(wide):
    """A key with most rows is read by several tasks, not one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    old = {k: wide.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            wide.conf.set(k, v)
        fact = wide.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
        dim = wide.range(60000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
        joined = J.join_star(fact, dim, "k").groupBy("k").agg(F.count("*").alias("rows"))
        hot = joined.where("k = 7")
        assert joined.collect() and "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert hot.first().rows == 40000
    finally:
        for k, v in old.items():
            wide.conf.set(k, v)


def test_flag_absent_and_orphans(wide):
    left = wide.createDataFrame([("a",), ("b",), (None,)], "k string")
    ref = wide.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r.k: r.gone for r in J.flag_absent(left, ref, "k", "gone").collect()} == {"a": 0, "b": 1, None: 1}
    assert J.count_orphans(left, ref, "k").first().orphans == 2
    assert [r.k for r in J.keep_referenced(left, ref, "k").collect()] == ["a"]


def test_histogram_matches_numpy(wide):
    df = wide.createDataFrame([(Decimal(i * i) / 100,) for i in range(200)], "x decimal(12,2)")
    got = [r["count"] for r in A.histogram(df, "x").collect()]
    want, edges = np.histogram([i * i / 100 for i in range(200)], bins=30)
    assert got == want.tolist()
    assert [r.low for r in A.histogram(df, "x").collect()] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant(wide):
    got = {r.bin: r["count"] for r in A.histogram(wide.range(3).selectExpr("1 AS x"), "x").collect()}
    assert got[15] == 3 and sum(got.values()) == 3
    want, edges = np.histogram([1, 1, 1], bins=30)
    rows = A.histogram(wide.range(3).selectExpr("1 AS x"), "x").collect()
    assert [r["count"] for r in rows] == want.tolist() and [r.low for r in rows] == pytest.approx(edges[:-1].tolist())


def test_quantiles_keep_all_digits(wide):
    df = wide.createDataFrame([(Decimal("0.0000000012"), 3), (Decimal("0.0000000034"), 5)], "x decimal(20,10), y int")
    assert R.exact_median(df, "x").first()[0] == pytest.approx(2.3e-9, rel=1e-12)
    got = {r["column"]: r["value"] for r in R.exact_quantiles(df, ["x", "y"], [0.5]).collect()}
    assert got["x"] == pytest.approx(2.3e-9, rel=1e-12) and got["y"] == 4
    with pytest.raises(ValueError):
        R.exact_quantiles(wide.createDataFrame([], "x decimal(38,30), y bigint"), ["x", "y"], [0.5])


def test_monthly_series_fills_gaps(wide):
    df = wide.createDataFrame([("2024-01-05", 1), ("2024-04-30", 2)], "d string, v int").withColumn("d", F.to_date("d"))
    assert [r.total for r in A.monthly_series(df, "d", "v").collect()] == [1, 0, 0, 2]


def test_insensitive_text_groups_case_accents_and_blanks(wide):
    from ledgerlark.functions.text import insensitive

    df = wide.createDataFrame([("É",), ("e ",), ("E",), ("f",)], "t string")
    assert df.agg(F.count_distinct(insensitive(F.col("t")))).first()[0] == 2
    assert df.agg(F.count_distinct("t")).first()[0] == 4


def test_describe_picks_columns_by_type(wide):
    df = wide.createDataFrame([("a", 1, "2024-01-01"), ("a", 2, "2024-01-03"), (None, None, None)], "t string, n int, d string").withColumn("d", F.to_date("d"))
    got = A.describe(df)
    text, number, day = got["text"].first(), got["numbers"].first(), got["dates"].first()
    assert (text["count"], text.unique, text.top, text.freq) == (2, 1, "a", 2)
    assert (number["count"], number["mean"], number.q50) == (2, 1.5, 1.5)
    assert (str(day["min"]), str(day.q50), str(day["max"])) == ("2024-01-01", "2024-01-02", "2024-01-03")


def test_floating_columns(wide):
    x = np.random.default_rng(2).normal(size=500)
    df = wide.createDataFrame([(float(v),) for v in x], "x double")
    assert [r["count"] for r in A.histogram(df, "x").collect()] == np.histogram(x, bins=30)[0].tolist()
    got = {r.q: r.value for r in R.exact_quantiles(df, ["x"], [0.1, 0.5]).collect()}
    assert got[0.1] == pytest.approx(np.quantile(x, 0.1), rel=1e-12) and got[0.5] == pytest.approx(np.quantile(x, 0.5), rel=1e-12)


def test_results_do_not_depend_on_the_number_of_partitions(wide):
    def run(partitions):
        wide.conf.set("spark.sql.shuffle.partitions", str(partitions))
        df = rows(wide).repartition(partitions)
        split = stratified_split(df.select(F.col("id").alias("customer_id"), F.col("g").alias("churned")))
        return [
            sorted(map(tuple, part.collect()))
            for part in (R.global_rank(df, ["v", "id"]), R.keep_first(df, "v", ["id"]), split.select("customer_id", "is_test"),
                         R.exact_quantiles(df, ["v"], [0.5]))
        ]

    try:
        assert run(1) == run(8)
    finally:
        wide.conf.set("spark.sql.shuffle.partitions", "4")

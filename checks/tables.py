"""Views the checks share, on top of `DriverTables`."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

from ledgerlark.operators import churn, cleaning, explain, features, segments
from ledgerlark.operators.colocated import Colocated, colocate
from ledgerlark.session import shuffles_dropped, stage, tune
from ledgerlark.sources.driver_tables import CUTOFF, OBSERVATION_END, DriverTables


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form both engines share."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        F.col(f"`{c}`").cast("double").alias(c) if isinstance(k, DecimalType) else F.col(f"`{c}`") for c, k in kinds.items()
    ])


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in cols})


_DIGEST = ["_h1", "_h2"]


def _digested(df: DataFrame) -> DataFrame:
    """Add 128 bits for each row, from all its values and which of them are null."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return df.withColumns({name: F.xxhash64(F.lit(seed), nulls, *cols) for seed, name in enumerate(_DIGEST)})


def differences(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(source, rows, differences) of written tables: rows that only the table or only its copy has.

    One table after the other, and only digests of the rows are shuffled: how often the table has a
    row, less how often its copy has it. Rows whose numbers are not alike are compared as they are.
    """
    found, spark = [], None
    for name, (own, copy) in tables.items():
        spark = own.sparkSession
        sides = _digested(own), _digested(copy.select(*own.columns))
        signs = [df.select(*_DIGEST, F.lit(sign).cast("long").alias("sign")) for df, sign in zip(sides, (1, -1), strict=True)]
        net = signs[0].unionByName(signs[1]).groupBy(*_DIGEST).agg(F.sum("sign").alias("net"), F.count_if(F.col("sign") < 0).alias("rows"))
        with shuffles_dropped(spark):
            told = net.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count_if(F.col("net") != 0).alias("off")).first()
            off = 0
            if told["off"]:
                unlike = stage(net.where(F.col("net") != 0).select(*_DIGEST), "unlike")
                left, right = (df.join(unlike, _DIGEST, "left_semi").drop(*_DIGEST) for df in sides)
                off = left.exceptAll(right).unionByName(right.exceptAll(left)).count()
        found.append((name, told["rows"], off))
    return spark.createDataFrame(found, "source string, rows long, differences long")


def _unless(bad, value):
    return F.when(~bad, value)


class CheckTables(DriverTables):
    cutoff, obs_end = CUTOFF, OBSERVATION_END

    @cached_property
    def rfm(self) -> DataFrame:
        return features.build_rfm_features(self.customers, self.headers, self.cutoff)

    @cached_property
    def scores(self) -> DataFrame:
        return features.add_rfm_scores(self.rfm)

    @cached_property
    def features(self) -> DataFrame:
        return features.build_customer_features(self.customers, self.headers, self.items, self.products, self.cutoff)

    @cached_property
    def labels(self) -> DataFrame:
        return features.build_churn_labels(self.headers, self.customers, self.cutoff, self.obs_end)

    @cached_property
    def churnset(self) -> DataFrame:
        return features.churn_dataset(self.features, self.labels)

    @cached_property
    def predictions(self) -> DataFrame:
        """Given predictions: a probability that grows with recency, for eligible customers."""
        days = F.least("recency_days", F.lit(500))
        return self.labels.join(self.rfm.select("customer_id", "recency_days"), "customer_id").select(
            "customer_id",
            F.col("churned").alias("actual_churned"),
            (days >= 250).cast("int").alias("predicted_churned"),
            (days.cast("double") / 500).alias("churn_probability"),
        )

    @cached_property
    def segments(self) -> DataFrame:
        """Given segments by fixed thresholds."""
        r, f = F.col("recency_days"), F.col("frequency")
        cluster = (
            F.when((r <= 60) & (f >= 12), 0).when((r <= 180) & (f >= 8), 1).when(r <= 120, 2)
            .when(F.col("monetary") >= 2500000, 3).otherwise(4)
        )
        names = ["Champions", "Loyal Customers", "New Customers", "At Risk", "Hibernating"]
        return self.rfm.withColumn("cluster", cluster).select(
            "customer_id", "recency_days", "frequency", "monetary", "cluster",
            F.element_at(F.array(*[F.lit(n) for n in names]), F.col("cluster") + 1).alias("segment"),
        )

    # --- tables with defects in known places ---

    def _copied(self, df: DataFrame, key: str, every: int, text: str) -> DataFrame:
        copies = df.where(F.col(key) % every == 0).withColumn(text, F.concat(text, F.lit(" (copy)")))
        return df.withColumn("arrival", F.lit(0)).unionByName(copies.withColumn("arrival", F.lit(1)))

    @cached_property
    def dirty_customers(self) -> DataFrame:
        k = F.col("_k")
        base = self._copied(self.customers, "customer_id", 17, "name").withColumn("_k", F.col("customer_id"))
        holes = {
            "customer_id": 101, "name": 41, "email": 19, "gender": 43, "age": 37, "city": 23, "state": 47, "region": 53,
            "loyalty_tier": 29, "loyalty_points": 59,
        }
        return base.withColumns({
            **{c: _unless(k % m == 0, F.col(c)) for c, m in holes.items()},
            "signup_date": F.when(k % 31 == 0, "not a date").otherwise(F.col("signup_date").cast("string")),
        }).drop("_k")

    @cached_property
    def dirty_products(self) -> DataFrame:
        k, price, cost = F.col("_k"), F.col("unit_price"), F.col("unit_cost")
        money = "decimal(10,2)"
        base = self._copied(self.products, "product_id", 13, "product_name").withColumn("_k", F.col("product_id"))
        return base.withColumns({
            "product_id": _unless(k % 97 == 0, F.col("product_id")),
            "unit_cost": F.when(k % 43 == 0, (price + 1).cast(money)).when(k % 47 != 0, cost),
            "unit_price": F.when(k % 29 == 0, F.lit(None).cast(money)).when(k % 31 == 0, F.lit(0).cast(money)).otherwise(price),
        }).drop("_k")

    @cached_property
    def dirty_orders(self) -> DataFrame:
        k, total = F.col("order_id"), F.col("total_amount")
        return self._copied(self.orders, "order_id", 19, "payment_method").withColumns({
            "customer_id": F.when(k % 53 == 0, -F.col("customer_id") - 1).when(k % 59 != 0, F.col("customer_id")),
            "order_date": F.when(k % 61 == 0, "2001-02-30").otherwise(F.col("order_date").cast("string")),
            "total_amount": F.when(k % 67 == 0, -total).when(k % 71 != 0, total),
        })

    @cached_property
    def dirty_items(self) -> DataFrame:
        h, share = F.col("_h"), "decimal(5,4)"
        total, discount = F.col("line_total"), F.col("discount")
        return self.items.withColumn("_h", F.col("order_id") * 7 + F.col("product_id")).withColumns({
            "order_id": F.when(h % 73 == 0, -F.col("order_id") - 1).otherwise(F.col("order_id")),
            "product_id": F.when(h % 79 == 0, F.lit(-1).cast("long")).otherwise(F.col("product_id")),
            "quantity": F.when(h % 83 == 0, 0).when(h % 89 != 0, F.col("quantity")),
            "discount": F.when(h % 103 == 0, F.lit("-0.1").cast(share)).when(h % 107 == 0, F.lit("1.5").cast(share)).when(h % 109 != 0, discount),
            "line_total": F.when(h % 97 == 0, -total).when(h % 101 != 0, total),
        }).drop("_h")

    @cached_property
    def cleaned_customers(self) -> cleaning.Cleaned:
        return cleaning.clean_customers(self.dirty_customers, ["arrival"])

    @cached_property
    def cleaned_products(self) -> cleaning.Cleaned:
        return cleaning.clean_products(self.dirty_products, ["arrival"])

    @cached_property
    def cleaned_orders(self) -> tuple[cleaning.Cleaned, cleaning.Cleaned]:
        return cleaning.clean_orders_and_items(
            self.dirty_orders, self.dirty_items, self.cleaned_customers.rows, self.cleaned_products.rows, ["arrival"]
        )

    @cached_property
    def quality(self) -> DataFrame:
        orders, items = self.cleaned_orders
        return self.cleaned_customers.report.unionByName(self.cleaned_products.report).unionByName(
            orders.report).unionByName(items.report)

    # --- trained models ---

    @cached_property
    def placed(self) -> Colocated:
        """Orders and lines laid out together."""
        return colocate(self.orders, self.items)

    @cached_property
    def churn_run(self) -> churn.ChurnRun:
        return churn.train_churn_models(stage(self.churnset, "churnset"))

    @cached_property
    def shap(self) -> tuple[DataFrame, float]:
        test = self.churn_run.split.where("is_test")
        phi, base = explain.forest_shap(self.churn_run.forest, test, churn.CHURN_FEATURE_COLUMNS)
        return stage(phi, "shap"), base

    @cached_property
    def staged_rfm(self) -> DataFrame:
        return stage(self.rfm, "rfm")

    @cached_property
    def sweep(self) -> segments.Sweep:
        vectors, _ = segments.prepare_features(self.staged_rfm)
        return segments.choose_k(vectors, ks=range(2, 9))

    @cached_property
    def found_segments(self) -> DataFrame:
        vectors, _ = segments.prepare_features(self.staged_rfm)
        return stage(segments.assign_segments(vectors, self.sweep.models[self.sweep.best_k]), "segments")


_known: dict[tuple, CheckTables] = {}


def tables(spark, folder: str) -> CheckTables:
    """One set of views per session and folder, so that models are trained once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _known:
        _known[key] = CheckTables(tune(spark), folder)
    return _known[key]

"""Checks of sources, projections, joins, aggregates, windows, order and functions (S, P, J, A, W, T, F)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from checks.catalog import add
from checks.oracle import CUT, big, cents, dbl, div, even, hup, int_, r6
from checks.tables import differences, plain, rounded
from ledgerlark import schemas
from ledgerlark.functions import numeric, text
from ledgerlark.functions.encode import band, encode, member, place
from ledgerlark.operators import aggregates, joins, ranking
from ledgerlark.operators.churn import hash_order
from ledgerlark.operators.metrics import precision_recall_f1, roc_auc
from ledgerlark.operators.star import date_dimension
from ledgerlark.plans import business
from ledgerlark.plans.extracts import customer_extract
from ledgerlark.session import staging_path
from ledgerlark.sources import tables as io
from ledgerlark.sources.driver_tables import TIERS



def _n():
    return F.count(F.lit(1))


TIER_ORDER = ["Bronze", "Silver", "Gold", "Platinum"]
TIER_RANK = "CASE loyalty_tier WHEN 'Bronze' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Gold' THEN 3 WHEN 'Platinum' THEN 4 ELSE 0 END"


# --- S: sources and sinks ---


def _number_keys(schema):
    """The given tables have whole-number keys."""
    return schemas.with_keys(schema, LongType())


CUSTOMERS, PRODUCTS, ITEMS = (_number_keys(s) for s in (schemas.CUSTOMERS, schemas.PRODUCTS, schemas.ORDER_ITEMS))
ORDER_DOCUMENTS = StructType([
    *_number_keys(schemas.ORDERS),
    StructField("items", ArrayType(StructType([f for f in ITEMS if f.name != "order_id"]))),
])
DOUBLE_ITEM = f"{dbl('unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total"


def _written(t, name, df, writer, **options):
    path = staging_path(t.spark, name)
    writer(df, path, **options)
    return path


def _documents(t):
    """Order documents with an embedded list; one document per line, so that no row grows without bound."""
    fields = [f.name for f in ITEMS if f.name != "order_id"]
    docs = t.items.join(t.orders, "order_id")
    return docs.select(
        F.lit("x").alias("_id"), *[f.name for f in ORDER_DOCUMENTS if f.name != "items"], F.array(F.struct(*fields)).alias("items")
    )


def _scan_csv(t):
    path = _written(t, "customers-csv", t.customers, io.write_csv)
    return io.read_csv(t.spark, path, CUSTOMERS)


def _scan_dates(t):
    path = _written(t, "dirty-csv", t.dirty_customers.drop("arrival"), io.write_csv)
    return io.read_csv_parsing_dates(t.spark, path, CUSTOMERS).select("customer_id", "signup_date")


def _given_sources(t):
    names = ["customer", "orders", "part", "lineitem"]
    return {n: io.Source(f"{t.folder}/{n}.parquet", t.raw(n).schema, "the driver") for n in names}


def _optional_inputs(t):
    sources = _given_sources(t) | {"segments": io.Source(f"{t.folder}/no_such_table", schemas.CUSTOMERS, "segmentation", optional=True)}
    found = io.load(t.spark, sources)
    return customer_extract(t.customers, t.features, found["segments"]).select(
        "customer_id", "segment", "churn_probability", "churn_risk_band"
    )


def _upserted(t):
    """Customer documents as of the cutoff, brought up to date by one document per later order."""
    seen = t.headers.where(F.col("order_date") <= F.lit(t.cutoff))
    last = seen.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"), F.max_by("channel", F.struct("order_date", "order_id")).alias("channel")
    )
    target = last.join(t.customers.select("customer_id", "name"), "customer_id")
    later = t.headers.where(F.col("order_date") > F.lit(t.cutoff)).select(
        "customer_id", F.col("order_date").alias("last_order_date"), "order_id", "channel"
    )
    return io.upsert(target, later, "customer_id", ["last_order_date", "order_id"])


def _metadata(t):
    quality = precision_recall_f1(t.predictions)
    record = quality.select(F.lit("recency").alias("model"), *quality.columns, roc_auc(t.predictions).scalar().alias("roc_auc"))
    path = _written(t, "metrics-json", rounded(record, *quality.columns, "roc_auc", places=3), io.write_json)
    return io.read_with_fallback(t.spark, [f"{path}-elsewhere", path], schemas.METRICS)


def _star_load(t):
    folder = staging_path(t.spark, "star")
    dims = {"dim_customer": t.customers, "dim_product": t.products, "dim_date": date_dimension(t.headers)}
    io.write_star(t.spark, folder, dims, t.sales)
    return differences({
        n: (df, io.read_star(t.spark, folder, n)) for n, df in (dims | {"fact_sales": t.sales}).items()
    })


def _views(t):
    io.register_views(t.spark, {"fact_sales": t.sales_lean})
    return t.spark.sql(
        "SELECT payment_method, CAST(SUM(line_total) AS DOUBLE) AS revenue, COUNT(*) AS line_items FROM fact_sales GROUP BY payment_method"
    )


def _torn_lines(t):
    """Customers as lines, of which some lack fields, some have one more and some have no number as age."""
    fields = [F.col(f.name).cast("string") for f in CUSTOMERS]
    torn = [F.lit("old") if f.name == "age" else F.col(f.name).cast("string") for f in CUSTOMERS]
    kind = F.col("customer_id") % 7
    return t.customers.select(
        F.when(kind == 0, F.concat_ws(",", *fields[:3])).when(kind == 1, F.concat_ws(",", *fields, F.lit("more")))
        .when(kind == 2, F.concat_ws(",", *torn)).otherwise(F.concat_ws(",", *fields)).alias("value")
    )


def _rejects(t):
    path = _written(t, "torn", _torn_lines(t), lambda df, path: df.write.text(path))
    rows, lines = io.read_csv_with_rejects(t.spark, path, CUSTOMERS, header=False)
    return rows.select("customer_id", F.lit(None).cast("string").alias("line")).union(lines.select(F.lit(None).cast("long"), "line"))


def _line(*fields: str) -> str:
    return f"CONCAT_WS(',', {', '.join(f'CAST({f} AS VARCHAR)' for f in fields)})"


_NAMES = CUSTOMERS.names
_TORN = f"""CASE customer_id % 7 WHEN 0 THEN {_line(*_NAMES[:3])} WHEN 1 THEN {_line(*_NAMES, "'more'")}
            WHEN 2 THEN {_line(*["'old'" if n == 'age' else n for n in _NAMES])} END"""


def _other_fields(t):
    """Orders as documents, every third with a field that the schema does not have."""
    gift = F.when(F.col("order_id") % 3 == 0, F.struct(F.col("store_region").alias("place"), F.array("order_id", F.col("order_id") % 5).alias("marks")))
    lines = t.orders.select(F.to_json(F.struct(*t.orders.columns, gift.alias("gift"), F.lit("x").alias("_id"))).alias("value"))
    docs = io.read_whole_documents(t.spark, _written(t, "whole", lines, lambda df, path: df.write.text(path)), ORDER_DOCUMENTS)
    value = "variant_get(others['gift'], '{}', '{}')"
    return docs.selectExpr(
        "order_id", "channel", "array_join(map_keys(others), ',') AS others",
        f"{value.format('$.place', 'string')} AS place", f"{value.format('$.marks[1]', 'bigint')} AS mark",
    )


add("s01_rejected_lines", _rejects,
    f"SELECT CASE WHEN {_TORN} IS NULL THEN customer_id END AS customer_id, {_TORN} AS line FROM cust")
add("s05_other_fields", _other_fields,
    """SELECT order_id, channel, CASE WHEN order_id % 3 = 0 THEN 'gift' END AS others, CASE WHEN order_id % 3 = 0 THEN store_region END AS place,
              CASE WHEN order_id % 3 = 0 THEN order_id % 5 END AS mark FROM ord""")
add("s01_csv_scan", _scan_csv, "SELECT * FROM cust")
add("s02_csv_dates", _scan_dates, "SELECT customer_id, TRY_CAST(signup_date AS DATE) AS signup_date FROM dcust")
add("s03_required_inputs", lambda t: io.row_counts(io.load(t.spark, _given_sources(t))).drop("needs_data"),
    " UNION ALL ".join(f"SELECT '{n}' AS source, COUNT(*) AS rows FROM {n}" for n in ("customer", "orders", "part", "lineitem")))
add("s04_optional_inputs", _optional_inputs,
    "SELECT customer_id, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS DOUBLE) AS churn_probability, CAST(NULL AS VARCHAR) AS churn_risk_band FROM cust")
add("s05_document_scan",
    lambda t: plain(io.read_documents(t.spark, _written(t, "documents", _documents(t), io.write_json, compression="gzip"), ORDER_DOCUMENTS).withColumn("n_items", F.size("items")).drop("items")),
    f"SELECT ord.* REPLACE ({dbl('total_amount')} AS total_amount), CAST(1 AS INTEGER) AS n_items FROM itm JOIN ord USING (order_id)")
add("s06_upsert", _upserted,
    """SELECT c.customer_id, CASE WHEN EXISTS (SELECT 1 FROM stats s WHERE s.customer_id = c.customer_id) THEN name END AS name,
       o.order_date AS last_order_date, o.channel
       FROM cust c JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM hdr) o
       ON o.customer_id = c.customer_id AND rn = 1""")
add("s07_metadata_json", _metadata,
    """SELECT 'recency' AS model, ROUND(CAST(tp AS DOUBLE) / p, 3) AS precision, ROUND(CAST(tp AS DOUBLE) / a, 3) AS recall,
       ROUND(2.0::DOUBLE * tp / (p + a), 3) AS f1_score, ROUND(auc, 3) AS roc_auc
       FROM (SELECT COUNT(*) FILTER (actual_churned = 1 AND predicted_churned = 1) AS tp, SUM(predicted_churned) AS p, SUM(actual_churned) AS a FROM preds),
            (SELECT (SUM(CASE WHEN actual_churned = 1 THEN avg_rank END) - SUM(actual_churned) * (SUM(actual_churned) + 1) / 2.0::DOUBLE)
                    / (CAST(SUM(actual_churned) AS DOUBLE) * SUM(1 - actual_churned)) AS auc
             FROM (SELECT *, RANK() OVER (ORDER BY p10k) + (COUNT(*) OVER (PARTITION BY p10k) - 1) / 2.0::DOUBLE AS avg_rank FROM preds))""")
add("s08_csv_sink", lambda t: plain(io.read_csv(t.spark, _written(t, "items-csv", t.items, io.write_csv), ITEMS)),
    f"SELECT * REPLACE ({DOUBLE_ITEM}) FROM itm")
add("s09_star_load", _star_load,
    """SELECT *, CAST(0 AS BIGINT) AS differences FROM (
       SELECT 'dim_customer' AS source, COUNT(*) AS rows FROM cust UNION ALL SELECT 'dim_product', COUNT(*) FROM prod
       UNION ALL SELECT 'dim_date', COUNT(*) FROM cal UNION ALL SELECT 'fact_sales', COUNT(*) FROM sales)""")
add("s10_view_scan", _views,
    f"SELECT payment_method, {dbl('SUM(line_total)')} AS revenue, COUNT(*) AS line_items FROM sales GROUP BY payment_method")
add("s11_row_counts", lambda t: io.row_counts({"customers": t.customers, "products": t.products, "orders": t.headers}),
    " UNION ALL ".join(f"SELECT '{n}' AS source, COUNT(*) AS rows, COUNT(*) = 0 AS needs_data FROM {v}" for n, v in (("customers", "cust"), ("products", "prod"), ("orders", "hdr"))))

# --- P: projections, filters, nested data ---

add("p01_flatten_items", lambda t: plain(io.flatten_orders(_documents(t))[1]), f"SELECT * REPLACE ({DOUBLE_ITEM}) FROM itm JOIN hdr USING (order_id)".replace("SELECT *", "SELECT itm.*"))
add("p01_flatten_headers",
    lambda t: plain(ranking.keep_first(io.drop_internal(io.flatten_orders(_documents(t))[0]), "order_id", [])),
    f"SELECT * REPLACE ({dbl('total_amount')} AS total_amount) FROM ord WHERE order_id IN (SELECT order_id FROM itm)")
add("p02_drop_internal", lambda t: io.drop_internal(t.customers.withColumn("_archetype", F.upper("name"))), "SELECT * FROM cust")
add("p03_prune_columns", lambda t: joins.join_star(t.items.select("order_id", "quantity"), t.headers, "order_id", columns=["customer_id"]),
    "SELECT order_id, quantity, customer_id FROM itm JOIN hdr USING (order_id)")
add("p04_rename", lambda t: plain(t.headers.withColumnRenamed("order_date", "date_key").select("order_id", "date_key", "total_amount")),
    f"SELECT order_id, order_date AS date_key, {dbl('total_amount')} AS total_amount FROM hdr")
add("p05_fixed_columns", lambda t: t.sales.select("order_id", "customer_id", "product_id", "date_key", "quantity", "payment_method", "channel", "store_region"),
    "SELECT order_id, customer_id, product_id, date_key, quantity, payment_method, channel, store_region FROM sales")
add("p06_date_range", lambda t: t.headers.where((F.col("order_date") > F.lit(t.cutoff)) & (F.col("order_date") <= F.lit(t.obs_end))).select("order_id", "order_date"),
    f"SELECT order_id, order_date FROM hdr WHERE order_date > {CUT} AND order_date <= DATE '2001-08-01'")
add("p07_not_null", lambda t: t.dirty_customers.where(F.col("customer_id").isNotNull() & F.col("email").isNull()).select("customer_id", "email", "arrival"),
    "SELECT customer_id, email, arrival FROM dcust WHERE customer_id IS NOT NULL AND email IS NULL")
add("p08_not_member", lambda t: t.dirty_customers.where(~member(F.col("loyalty_tier"), TIER_ORDER)).select("customer_id", "loyalty_tier", "arrival"),
    f"SELECT customer_id, loyalty_tier, arrival FROM dcust WHERE {TIER_RANK} = 0")
add("p09_case_bucket", lambda t: t.items.select("order_id", "product_id", business.discount_band(F.col("discount")).alias("band")),
    """SELECT order_id, product_id, CASE WHEN discount = 0 THEN 'No discount' WHEN discount <= 0.1 THEN '1-10%'
       WHEN discount <= 0.2 THEN '11-20%' ELSE '20%+' END AS band FROM itm""")
add("p10_between", lambda t: t.items.where(F.col("quantity").between(4, 6)).select("order_id", "product_id", "quantity"),
    "SELECT order_id, product_id, quantity FROM itm WHERE quantity BETWEEN 4 AND 6")
add("p11_filter_on_rank", lambda t: business.top_customers_per_region(t.sales_lean, t.customers, n=3),
    f"""SELECT * FROM (SELECT region, customer_id, name, {dbl('rev')} AS revenue, {int_('RANK() OVER (PARTITION BY region ORDER BY rev DESC)')} AS region_rank
        FROM (SELECT customer_id, SUM(line_total) AS rev FROM sales GROUP BY customer_id) JOIN cust USING (customer_id)) WHERE region_rank <= 3""")
add("p12_cte", lambda t: plain(t.headers.groupBy("customer_id").agg(_n().alias("n")).groupBy("n").agg(_n().alias("customers"))),
    "SELECT n, COUNT(*) AS customers FROM (SELECT customer_id, COUNT(*) AS n FROM hdr GROUP BY customer_id) GROUP BY n")
add("p13_scalar_subquery",
    lambda t: t.headers.groupBy("customer_id").agg(F.datediff(t.headers.agg(F.max("order_date")).scalar(), F.max("order_date")).alias("days_since")),
    f"SELECT customer_id, {int_('(SELECT MAX(order_date) FROM hdr) - MAX(order_date)')} AS days_since FROM hdr GROUP BY customer_id")
add("p14_suffixes", lambda t: plain(joins.left_join_suffixed(t.customers, t.features, "customer_id", "_feat")).select(
    "customer_id", "age", "age_feat", "region_feat", "gender_feat", "loyalty_tier_feat", "loyalty_points_feat", "recency_days"),
    """SELECT customer_id, c.age, f.age AS age_feat, f.region AS region_feat, f.gender AS gender_feat, f.loyalty_tier AS loyalty_tier_feat,
       f.loyalty_points AS loyalty_points_feat, recency_days FROM cust c LEFT JOIN feat f USING (customer_id)""")

# --- J: joins ---

add("j01_inner_fact", lambda t: joins.join_star(t.items, t.headers, "order_id", columns=["customer_id", "channel"]).groupBy("channel").agg(_n().alias("line_items")),
    "SELECT channel, COUNT(*) AS line_items FROM itm JOIN hdr USING (order_id) GROUP BY channel")
add("j02_left_products", lambda t: joins.join_star(t.dirty_items, t.products, "product_id", "left", ["category"]).groupBy("category").agg(_n().alias("line_items")),
    "SELECT category, COUNT(*) AS line_items FROM ditm LEFT JOIN prod USING (product_id) GROUP BY category")
add("j03_left_customers", lambda t: plain(t.customers.select("customer_id").join(
        t.headers.where(F.col("order_date") > F.lit(t.cutoff)).groupBy("customer_id").agg(F.sum("total_amount").alias("spend")), "customer_id", "left"
    ).withColumn("spend", F.coalesce("spend", F.lit(0)))),
    f"""SELECT customer_id, {dbl('COALESCE(s, 0)')} AS spend FROM cust LEFT JOIN
        (SELECT customer_id, SUM(total_amount) AS s FROM hdr WHERE order_date > {CUT} GROUP BY customer_id) USING (customer_id)""")
add("j04_eligible", lambda t: t.rfm.join(t.labels, "customer_id").select("customer_id", "recency_days", "churned"),
    "SELECT customer_id, recency_days, churned FROM rfm JOIN churnlab USING (customer_id)")
add("j05_semi", lambda t: joins.keep_referenced(t.dirty_orders, t.customers, "customer_id").select("order_id", "customer_id", "arrival"),
    "SELECT order_id, customer_id, arrival FROM dord WHERE customer_id IN (SELECT customer_id FROM cust)")
add("j06_orphans", lambda t: joins.count_orphans(t.dirty_items, t.products, "product_id"),
    "SELECT COUNT(*) AS orphans FROM ditm d WHERE NOT EXISTS (SELECT 1 FROM prod p WHERE p.product_id = d.product_id)")
add("j07_flag_absent", lambda t: joins.flag_absent(t.customers.select("customer_id"), t.headers.where(F.col("order_date") > F.lit(t.cutoff)), "customer_id", "inactive"),
    f"""SELECT customer_id, {int_(f"NOT EXISTS (SELECT 1 FROM hdr h WHERE h.customer_id = c.customer_id AND order_date > {CUT})")} AS inactive FROM cust c""")
add("j08_index_aligned", lambda t: plain(t.headers.select("order_id").join(t.items.groupBy("order_id").agg(F.sum("line_total").alias("computed_total")), "order_id", "left")
    .withColumn("computed_total", F.coalesce("computed_total", F.lit(0)))),
    f"SELECT order_id, {dbl('COALESCE(s, 0)')} AS computed_total FROM hdr LEFT JOIN (SELECT order_id, SUM(line_total) AS s FROM itm GROUP BY order_id) USING (order_id)")


def _two_windows(t):
    day, total = F.col("order_date"), F.col("total_amount")
    recent = day > F.date_sub(F.lit(t.cutoff), 90)
    window = t.headers.where((day <= F.lit(t.cutoff)) & (day > F.date_sub(F.lit(t.cutoff), 180)))
    return plain(aggregates.conditional_sums(window, ["customer_id"], {"recent_90d_spend": (recent, total), "prior_90d_spend": (~recent, total)}))


add("j09_outer_union", _two_windows,
    f"SELECT customer_id, {dbl('recent')} AS recent_90d_spend, {dbl('prior')} AS prior_90d_spend FROM stats WHERE last_day > {CUT} - 180")
add("j10_star_join", lambda t: plain(t.sales_lean.join(F.broadcast(date_dimension(t.headers).select("date_key", "quarter", "is_weekend")), "date_key")
    .groupBy("quarter", "is_weekend").agg(F.sum("line_total").alias("revenue"))),
    f"SELECT quarter, is_weekend, {dbl('SUM(line_total)')} AS revenue FROM sales JOIN cal USING (date_key) GROUP BY quarter, is_weekend")
add("j11_left_dim", lambda t: t.customers.select("customer_id", "loyalty_tier").join(
        t.sales_lean.where(F.col("date_key") > F.lit(t.cutoff)).groupBy("customer_id").agg(_n().alias("n")), "customer_id", "left"
    ).groupBy("loyalty_tier").agg(_n().alias("customers"), F.count_if(F.col("n").isNull()).alias("without_sales")),
    f"""SELECT loyalty_tier, COUNT(*) AS customers, COUNT(*) FILTER (n IS NULL) AS without_sales FROM cust LEFT JOIN
        (SELECT customer_id, COUNT(*) AS n FROM sales WHERE date_key > {CUT} GROUP BY customer_id) USING (customer_id) GROUP BY loyalty_tier""")
add("j12_dictionary", lambda t: t.raw("customer").select(F.col("c_custkey").alias("customer_id"), encode(F.col("c_mktsegment"), TIERS, "Unknown").alias("loyalty_tier")),
    "SELECT customer_id, loyalty_tier FROM cust")

# --- A: aggregates ---

add("a01_sum_count", lambda t: plain(t.items.groupBy("product_id").agg(F.sum("line_total").alias("revenue"), _n().alias("line_items"))),
    f"SELECT product_id, {dbl('SUM(line_total)')} AS revenue, COUNT(*) AS line_items FROM itm GROUP BY product_id")
add("a02_count_distinct", lambda t: t.sales_lean.groupBy("channel").agg(F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers")),
    "SELECT channel, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers FROM sales GROUP BY channel")
add("a03_min_max", lambda t: t.headers.groupBy("customer_id").agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")),
    "SELECT customer_id, MIN(order_date) AS first_day, MAX(order_date) AS last_day FROM hdr GROUP BY customer_id")
add("a04_mean", lambda t: t.items.groupBy("product_id").agg(numeric.mean("quantity").alias("avg_quantity"), numeric.mean("discount").alias("avg_discount")),
    f"SELECT product_id, {div('SUM(quantity)', 'COUNT(quantity)')} AS avg_quantity, {div('SUM(discount)', 'COUNT(discount)')} AS avg_discount FROM itm GROUP BY product_id")
add("a05_conditional", lambda t: plain(aggregates.conditional_sums(t.headers, ["customer_id"], {
    "online": (F.col("channel") == "Online", F.col("total_amount")), "in_store": (F.col("channel") == "In-Store", F.col("total_amount"))})),
    f"""SELECT customer_id, {dbl("SUM(CASE WHEN channel = 'Online' THEN total_amount ELSE 0 END)")} AS online,
        {dbl("SUM(CASE WHEN channel = 'In-Store' THEN total_amount ELSE 0 END)")} AS in_store FROM hdr GROUP BY customer_id""")
add("a06_median", lambda t: aggregates.masked_median(t.headers, "total_amount", F.col("channel") == "Online"),
    "SELECT QUANTILE_CONT(CAST(total_amount AS DOUBLE), 0.5) AS median FROM hdr WHERE channel = 'Online'")
add("a07_global", lambda t: plain(t.items.agg(F.sum("line_total").alias("revenue"), F.count_distinct("order_id").alias("orders"))),
    f"SELECT {dbl('SUM(line_total)')} AS revenue, COUNT(DISTINCT order_id) AS orders FROM itm")
add("a08_multi_key", lambda t: plain(t.sales.groupBy("store_region", "channel", "payment_method").agg(F.sum("line_total").alias("revenue"))),
    f"SELECT store_region, channel, payment_method, {dbl('SUM(line_total)')} AS revenue FROM sales GROUP BY ALL")
add("a09_group_by_alias", lambda t: t.headers.groupBy(F.year("order_date").alias("year")).agg(_n().alias("orders")),
    f"SELECT {int_('YEAR(order_date)')} AS year, COUNT(*) AS orders FROM hdr GROUP BY year")
add("a10_ratio", lambda t: t.sales_lean.groupBy("customer_id").agg(numeric.ratio(F.sum("line_total"), F.count_distinct("order_id")).alias("order_value")),
    f"SELECT customer_id, {hup(cents('SUM(line_total)'), 'COUNT(DISTINCT order_id) * 100')} AS order_value FROM sales GROUP BY customer_id")
add("a11_share", lambda t: aggregates.with_share(t.customers.groupBy("region").agg(_n().alias("customers")), "customers", "pct"),
    f"SELECT region, COUNT(*) AS customers, {even(div('COUNT(*)', 'SUM(COUNT(*)) OVER ()') + ' * 100', 1)} AS pct FROM cust GROUP BY region")
add("a12_two_level", lambda t: business.order_count_buckets(t.sales_lean.where(F.col("date_key") > F.lit(t.cutoff))),
    f"""SELECT CASE WHEN n = 1 THEN '1 order' WHEN n <= 3 THEN '2-3 orders' WHEN n <= 6 THEN '4-6 orders' ELSE '7+ orders' END AS frequency_bucket,
        COUNT(*) AS customers FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS n FROM sales WHERE date_key > {CUT} GROUP BY customer_id) GROUP BY 1""")
add("a13_value_counts", lambda t: aggregates.frequency(t.headers, "payment_method"), "SELECT payment_method, COUNT(*) AS count FROM hdr GROUP BY payment_method")
add("a14_group_means", lambda t: t.rfm.groupBy("frequency").agg(numeric.mean("recency_days").alias("recency_days"), numeric.mean("monetary").alias("monetary")),
    f"SELECT frequency, {div('SUM(recency_days)', 'COUNT(*)')} AS recency_days, {div('SUM(monetary)', 'COUNT(*)')} AS monetary FROM rfm GROUP BY frequency")
DIRTY_CUSTOMER_COLUMNS = [*schemas.CUSTOMERS.names, "arrival"]
add("a15_null_counts", lambda t: aggregates.null_counts(t.dirty_customers),
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS nulls FROM dcust" for c in DIRTY_CUSTOMER_COLUMNS))


def _describe_sql(view, cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count, {r6(f'SUM({c}) / COUNT({c})')} AS mean, {r6(f'STDDEV_SAMP(CAST({c} AS DOUBLE))', 4)} AS std,
            {dbl(f'MIN({c})')} AS min, {r6(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25)')} AS q25, {r6(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5)')} AS q50,
            {r6(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75)')} AS q75, {dbl(f'MAX({c})')} AS max FROM {view}"""
        for c in cols
    )


add("a16_describe_numbers",
    lambda t: rounded(rounded(aggregates.describe_numbers(t.customers, ["age", "loyalty_points"]), "mean", "q25", "q50", "q75"), "std", places=4),
    _describe_sql("cust", ["age", "loyalty_points"]))
add("a16_describe_orders", lambda t: rounded(rounded(aggregates.describe_numbers(t.headers, ["total_amount"]), "mean", "q25", "q50", "q75"), "std", places=4),
    _describe_sql("hdr", ["total_amount"]))
for _table, _view, _cols in (("items", "itm", ["quantity", "unit_price", "line_total"]), ("products", "prod", ["unit_cost", "unit_price"])):
    add(f"a16_describe_{_table}", lambda t, n=_table, c=_cols: rounded(rounded(aggregates.describe_numbers(getattr(t, n), c), "mean", "q25", "q50", "q75"), "std", places=4),
        _describe_sql(_view, _cols))
# Five places: the mean of the discounts ends in a 5 at the sixth.
add("a16_describe_discounts", lambda t: rounded(rounded(aggregates.describe_numbers(t.items, ["discount"]), "mean", "q25", "q50", "q75", places=5), "std", places=4),
    _describe_sql("itm", ["discount"]).replace(", 6)", ", 5)"))
TEXTS = ["name", "gender", "city", "region", "loyalty_tier"]
add("a16_describe_text", lambda t: aggregates.describe_text(t.dirty_customers, TEXTS),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {big('SUM(n)')} AS count, COUNT(*) AS "unique", ARG_MIN(v, ROW(-n, v)) AS top, MAX(n) AS freq
            FROM (SELECT {c} AS v, COUNT(*) AS n FROM dcust WHERE {c} IS NOT NULL GROUP BY 1)""" for c in TEXTS))
add("a16_describe_dates", lambda t: aggregates.describe(t.headers)["dates"],
    """SELECT 'order_date' AS "column", COUNT(*) AS count, MIN(order_date) AS min, MAX(order_date) AS max, """
    + ", ".join(f"DATE '1970-01-01' + CAST(FLOOR(QUANTILE_CONT(CAST(order_date - DATE '1970-01-01' AS DOUBLE), 0.{q})) AS INTEGER) AS q{q}" for q in ("25", "50", "75"))
    + " FROM hdr")
add("a17_monthly_series", lambda t: plain(aggregates.monthly_series(t.headers.where(F.month("order_date") != 2), "order_date", "total_amount")),
    f"""SELECT m AS month_start, {dbl('COALESCE(s, 0)')} AS total FROM
        (SELECT CAST(UNNEST(GENERATE_SERIES(MIN(DATE_TRUNC('month', order_date)), MAX(DATE_TRUNC('month', order_date)), INTERVAL 1 MONTH)) AS DATE) AS m
         FROM hdr WHERE MONTH(order_date) <> 2)
        LEFT JOIN (SELECT CAST(DATE_TRUNC('month', order_date) AS DATE) AS m, SUM(total_amount) AS s FROM hdr WHERE MONTH(order_date) <> 2 GROUP BY 1) USING (m)""")


def _histogram_sql(view, col, scale=1, bins=30):
    x = f"CAST({col} * {scale} AS HUGEINT)"
    return f"""SELECT {big('b')} AS bin, {r6(f'lo + w * b')} AS low, {r6(f'lo + w * (b + 1)')} AS high, COALESCE(c, 0) AS count
        FROM (SELECT UNNEST(RANGE({bins})) AS b, CAST(MIN({col}) AS DOUBLE) AS lo, (CAST(MAX({col}) AS DOUBLE) - CAST(MIN({col}) AS DOUBLE)) / {bins} AS w FROM {view})
        LEFT JOIN (SELECT LEAST((x - x0) * {bins} // (x1 - x0), {bins - 1}) AS b, COUNT(*) AS c
                   FROM (SELECT {x} AS x, MIN({x}) OVER () AS x0, MAX({x}) OVER () AS x1 FROM {view}) GROUP BY 1) USING (b)"""


for _c, _s in (("recency_days", 1), ("frequency", 1), ("monetary", 100)):
    add(f"a18_histogram_{_c}", lambda t, c=_c: rounded(aggregates.histogram(t.rfm, c), "low", "high"), _histogram_sql("rfm", _c, _s))
add("a19_distinct_keys", lambda t: t.headers.where(F.col("order_date") > F.lit(t.cutoff)).select("customer_id").distinct(),
    f"SELECT DISTINCT customer_id FROM hdr WHERE order_date > {CUT}")

# --- W: windows and ranks ---

MONTHLY = """(SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month, SUM(total_amount) AS rev FROM hdr GROUP BY 1, 2)"""


def _months(t):
    return t.headers.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(F.sum("total_amount").alias("rev"))


def _in_order():
    return Window.orderBy("year", "month")


add("w01_lag", lambda t: plain(_months(t).select("year", "month", F.lag("rev").over(_in_order()).alias("prev"))),
    f"SELECT year, month, {dbl('LAG(rev) OVER (ORDER BY year, month)')} AS prev FROM {MONTHLY}")
add("w02_running_sum", lambda t: plain(_months(t).select("year", "month", F.sum("rev").over(_in_order()).alias("running"))),
    f"SELECT year, month, {dbl('SUM(rev) OVER (ORDER BY year, month)')} AS running FROM {MONTHLY}")
add("w02_running_sum_at_scale", lambda t: plain(ranking.running_total(t.headers.select("order_id", "order_date", "total_amount"), ["order_date", "order_id"], "total_amount")
    .select("order_id", "running")),
    f"SELECT order_id, {dbl('SUM(total_amount) OVER (ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)')} AS running FROM hdr")
add("w03_sum_of_sums", lambda t: plain(t.items.groupBy("quantity").agg(F.sum("line_total").alias("rev")).select("quantity", F.sum("rev").over(Window.partitionBy()).alias("whole"))),
    f"SELECT quantity, {dbl('SUM(SUM(line_total)) OVER ()')} AS whole FROM itm GROUP BY quantity")
add("w04_rank", lambda t: t.headers.groupBy("customer_id").agg(_n().alias("n")).join(t.customers.select("customer_id", "region"), "customer_id")
    .withColumn("place", F.rank().over(Window.partitionBy("region").orderBy(F.desc("n")))).where(F.col("place") <= 5),
    f"""SELECT * FROM (SELECT customer_id, n, region, {int_('RANK() OVER (PARTITION BY region ORDER BY n DESC)')} AS place
        FROM (SELECT customer_id, COUNT(*) AS n FROM hdr GROUP BY customer_id) JOIN cust USING (customer_id)) WHERE place <= 5""")
add("w05_global_rank", lambda t: plain(ranking.global_rank(t.headers.select("order_id", "total_amount"), [F.desc("total_amount"), "order_id"])),
    f"SELECT order_id, {dbl('total_amount')} AS total_amount, ROW_NUMBER() OVER (ORDER BY total_amount DESC, order_id) AS rank FROM hdr")


def _order_quintiles(t):
    ranked = ranking.global_rank(t.headers.select("order_id", "total_amount"), ["total_amount", "order_id"])
    rows = ranked.agg(F.max("rank").alias("n")).scalar()
    return ranked.withColumn("n", rows).select("order_id", ranking.quantile_score(F.col("rank"), F.col("n")).alias("score"))


add("w06_quintiles", _order_quintiles,
    f"SELECT order_id, {int_('GREATEST(1, (5 * (r - 1) + n - 2) // (n - 1))')} AS score FROM (SELECT order_id, ROW_NUMBER() OVER (ORDER BY total_amount, order_id) AS r, COUNT(*) OVER () AS n FROM hdr)")
add("w07_keep_first", lambda t: plain(ranking.keep_first(t.dirty_orders, "order_id", ["arrival"])),
    f"SELECT * EXCLUDE (rn) REPLACE ({dbl('total_amount')} AS total_amount) FROM ord1")
add("w08_hash_order", lambda t: ranking.global_rank(t.labels.withColumn("mix", hash_order("customer_id", 42)), ["mix", "customer_id"], within=["churned"]),
    "SELECT customer_id, churned, mix, turn AS rank FROM dealt")

# --- T: order and limits ---

PER_PRODUCT = "(SELECT product_id, SUM(line_total) AS rev FROM itm GROUP BY product_id)"
add("t01_top_k", lambda t: plain(ranking.top_k(t.items.groupBy("product_id").agg(F.sum("line_total").alias("rev")), [F.desc("rev"), "product_id"], 20)),
    f"SELECT product_id, {dbl('rev')} AS rev FROM {PER_PRODUCT} t ORDER BY t.rev DESC, product_id LIMIT 20")
add("t02_bottom_k", lambda t: plain(ranking.top_k(t.items.groupBy("product_id").agg(F.sum("line_total").alias("rev")), [F.asc("rev"), "product_id"], 5)),
    f"SELECT product_id, {dbl('rev')} AS rev FROM {PER_PRODUCT} t ORDER BY t.rev, product_id LIMIT 5")
add("t03_fixed_order", lambda t: t.customers.groupBy("loyalty_tier").agg(_n().alias("customers")).withColumn("place", place(F.col("loyalty_tier"), TIER_ORDER)).orderBy("place"),
    f"SELECT loyalty_tier, COUNT(*) AS customers, {big(TIER_RANK)} AS place FROM cust GROUP BY loyalty_tier")
add("t03_reindex", lambda t: aggregates.frequency(t.customers, "loyalty_tier", ["Diamond", *TIER_ORDER]),
    "SELECT loyalty_tier, count FROM (VALUES ('Diamond'), ('Bronze'), ('Silver'), ('Gold'), ('Platinum')) v(loyalty_tier) LEFT JOIN (SELECT loyalty_tier, COUNT(*) AS count FROM cust GROUP BY loyalty_tier) USING (loyalty_tier)")
add("t04_best_row", lambda t: t.headers.agg(F.min_by("order_id", F.struct(-F.col("total_amount"), F.col("order_id"))).alias("largest"), F.min_by("order_id", F.struct("total_amount", "order_id")).alias("smallest")),
    """SELECT (SELECT order_id FROM hdr ORDER BY total_amount DESC, order_id LIMIT 1) AS largest, (SELECT order_id FROM hdr ORDER BY total_amount, order_id LIMIT 1) AS smallest""")
add("t05_head", lambda t: ranking.top_k(t.headers.select("order_id", "order_date"), ["order_date", "order_id"], 5), "SELECT order_id, order_date FROM hdr ORDER BY order_date, order_id LIMIT 5")

# --- F: scalar functions over whole tables ---

add("f01_parse_date", lambda t: t.dirty_orders.select("order_id", "arrival", text.parse_date(F.col("order_date")).alias("order_date")),
    "SELECT order_id, arrival, TRY_CAST(order_date AS DATE) AS order_date FROM dord")
add("f01_parse_timestamp_text", lambda t: t.dirty_orders.select("order_id", "arrival", text.parse_date(F.concat("order_date", F.lit("T10:30:00"))).alias("order_date")),
    "SELECT order_id, arrival, TRY_CAST(order_date AS DATE) AS order_date FROM dord")
add("f02_date_diff", lambda t: t.headers.select("order_id", F.datediff(F.lit(t.cutoff), "order_date").alias("days")),
    f"SELECT order_id, {int_(f'{CUT} - order_date')} AS days FROM hdr")
add("f03_date_shift", lambda t: t.headers.select("order_id", F.date_add("order_date", 90).alias("later"), F.date_sub("order_date", 180).alias("earlier")),
    "SELECT order_id, order_date + 90 AS later, order_date - 180 AS earlier FROM hdr")
add("f04_date_parts", lambda t: t.headers.select("order_id", F.year("order_date").alias("year"), F.quarter("order_date").alias("quarter"), F.month("order_date").alias("month"),
    F.day("order_date").alias("day"), text.month_name(F.col("order_date")).alias("month_name"), text.day_name(F.col("order_date")).alias("day_name"), F.weekday("order_date").alias("weekday")),
    f"""SELECT order_id, {int_('YEAR(order_date)')} AS year, {int_('QUARTER(order_date)')} AS quarter, {int_('MONTH(order_date)')} AS month, {int_('DAY(order_date)')} AS day,
        MONTHNAME(order_date) AS month_name, DAYNAME(order_date) AS day_name, {int_('ISODOW(order_date) - 1')} AS weekday FROM hdr""")
add("f05_date_range", lambda t: date_dimension(t.headers).select("date_key"), "SELECT date_key FROM cal")
add("f06_rounding", lambda t: t.items.select("order_id", "product_id", "quantity", F.round(F.col("unit_price") / 8, 2).cast("double").alias("half_up"), F.bround(F.col("quantity") / F.lit(4.0), 0).alias("half_even")),
    f"SELECT order_id, product_id, quantity, {hup(cents('unit_price'), '800')} AS half_up, {even('quantity / 4.0::DOUBLE')} AS half_even FROM itm")
add("f07_abs_clip_guard", lambda t: plain(t.dirty_items.select("order_id", "product_id", F.abs("line_total").alias("size"),
    numeric.clip(F.col("discount"), F.lit(0).cast("decimal(5,4)"), F.lit("0.9").cast("decimal(5,4)")).alias("clipped"), numeric.quotient(F.col("line_total"), F.col("quantity")).alias("each"))),
    f"""SELECT order_id, product_id, {dbl('ABS(line_total)')} AS size, {dbl('CASE WHEN discount < 0 THEN 0 WHEN discount > 0.9 THEN 0.9 ELSE discount END')} AS clipped,
        {div('line_total', 'quantity')} AS each FROM ditm""")
add("f08_coalesce_nullif", lambda t: t.dirty_items.select("order_id", "product_id", F.coalesce("quantity", F.lit(0)).alias("filled"), F.nullif("quantity", F.lit(0)).alias("nonzero")),
    "SELECT order_id, product_id, COALESCE(quantity, 0) AS filled, NULLIF(quantity, 0) AS nonzero FROM ditm")
add("f09_cast_concat", lambda t: t.customers.select(F.concat(F.col("customer_id").cast("string"), F.lit("-"), F.lower("name")).alias("tag"), F.col("age").cast("string").alias("age")),
    "SELECT CAST(customer_id AS VARCHAR) || '-' || lower(name) AS tag, CAST(age AS VARCHAR) AS age FROM cust")
add("f10_case", lambda t: t.headers.select("order_id", F.when(F.col("total_amount") < 100000, "small").when(F.col("total_amount") < 300000, "medium").otherwise("large").alias("size")),
    "SELECT order_id, CASE WHEN total_amount < 100000 THEN 'small' WHEN total_amount < 300000 THEN 'medium' ELSE 'large' END AS size FROM hdr")
add("f11_position", lambda t: t.customers.select("customer_id", place(F.col("loyalty_tier"), TIER_ORDER).alias("place")), f"SELECT customer_id, {big(TIER_RANK)} AS place FROM cust")
add("f12_bins", lambda t: t.rfm.select("customer_id", band(F.col("recency_days"), [-1, 30, 90, 180], ["month", "quarter", "half"]).alias("bin")),
    "SELECT customer_id, CASE WHEN recency_days <= 30 THEN 'month' WHEN recency_days <= 90 THEN 'quarter' WHEN recency_days <= 180 THEN 'half' END AS bin FROM rfm")
add("f13_padded_ids", lambda t: t.headers.select(text.padded_id("ORD", F.col("order_id"), 7).alias("tag"), text.padded_id("C", F.col("customer_id"), 2).alias("short_tag")),
    "SELECT 'ORD' || printf('%07d', order_id) AS tag, 'C' || printf('%02d', customer_id) AS short_tag FROM hdr")
add("f14_iso_dates", lambda t: t.headers.select("order_id", text.iso_date(F.col("order_date")).alias("day")), "SELECT order_id, strftime(order_date, '%Y-%m-%d') AS day FROM hdr")
add("f15_display", lambda t: t.rfm.select("customer_id", text.thousands(F.col("monetary"), 2).alias("spend"), text.percent_text(F.least("recency_days", F.lit(500)).cast("double") / 500).alias("share")),
    "SELECT customer_id, format('{:,.2f}', CAST(monetary AS DOUBLE)) AS spend, printf('%.1f', CAST(LEAST(recency_days, 500) AS DOUBLE) / 500 * 100) || '%' AS share FROM rfm")

"""Checks of reports, extracts, measures and exploration (B, K, N, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.catalog import add
from checks.oracle import CUT, END, big, dbl, div, even, int_, r6
from checks.tables import differences, plain, rounded
from checks.warehouse import PER_CUSTOMER, PRODUCTS
from ledgerlark.operators.aggregates import binned_pairs
from ledgerlark.operators.colocated import with_headers
from ledgerlark.operators.features import build_rfm_features
from ledgerlark.operators.star import date_dimension
from ledgerlark.plans import explore, extracts, measures, reports
from ledgerlark.session import staging_path
from ledgerlark.sources import tables as io

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
RISK = """CASE WHEN churn_probability <= 0.3 THEN 'Low' WHEN churn_probability <= 0.6 THEN 'Medium'
          WHEN churn_probability <= 1.0 THEN 'High' END"""

# --- B: report aggregates and extracts ---

add("b01_segment_summary", lambda t: reports.segment_summary(t.segments),
    f"""SELECT segment, COUNT(*) AS customers, {even(div('SUM(recency_days)', 'COUNT(*)'), 1)} AS avg_recency_days,
        {even(div('SUM(frequency)', 'COUNT(*)'), 1)} AS avg_frequency, {even(div('SUM(monetary)', 'COUNT(*)'), 1)} AS avg_monetary,
        {even(div('COUNT(*)', 'SUM(COUNT(*)) OVER ()') + ' * 100', 1)} AS pct_of_base FROM segs GROUP BY segment""")
add("b02_churn_summary", lambda t: rounded(reports.churn_summary(t.predictions), "avg_churn_probability"),
    f"""SELECT COUNT(*) AS scored_customers, {r6(div('SUM(p10k)', 'COUNT(*)') + ' / 10000')} AS avg_churn_probability,
        COUNT(*) FILTER (p10k >= 7000) AS high_risk_count, COUNT(*) FILTER (p10k >= 4000 AND p10k < 7000) AS medium_risk_count,
        COUNT(*) FILTER (p10k < 4000) AS low_risk_count, {div('SUM(actual_churned)', 'COUNT(*)')} AS actual_churn_rate_in_test_set FROM preds""")
add("b03_category_report", lambda t: reports.category_report(t.items, t.products),
    f"""SELECT category, {dbl('SUM(line_total)')} AS revenue, {big('SUM(quantity)')} AS units_sold, {even(div('SUM(discount)', 'COUNT(discount)'), 2)} AS avg_discount,
        {even(div('SUM(line_total)', 'SUM(SUM(line_total)) OVER ()') + ' * 100', 1)} AS pct_of_revenue FROM itm JOIN prod USING (product_id) GROUP BY category""")
add("b04_regional_report", lambda t: reports.regional_report(t.items, t.orders),
    f"""SELECT store_region, {dbl('SUM(line_total)')} AS revenue, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
        {even(div('SUM(line_total)', 'COUNT(DISTINCT order_id)'), 2)} AS avg_order_value FROM sales GROUP BY store_region""")
add("b05_bottom_products", lambda t: reports.bottom_products_report(t.items, t.products),
    f"""SELECT product_id, product_name, category, {dbl('rev')} AS revenue, avg_discount FROM
        (SELECT product_id, SUM(line_total) AS rev, {div('SUM(discount)', 'COUNT(discount)')} AS avg_discount FROM itm GROUP BY product_id)
        JOIN prod USING (product_id) ORDER BY rev, product_id LIMIT 5""")
CATEGORY = "(SELECT category, SUM(line_total) AS rev FROM itm JOIN prod USING (product_id) GROUP BY category)"
REGION = "(SELECT store_region, SUM(line_total) AS rev FROM sales GROUP BY store_region)"
add("b06_headline", lambda t: reports.headline(t.customers, t.orders, t.items, t.products),
    f"""SELECT {dbl('(SELECT SUM(line_total) FROM itm)')} AS total_revenue, (SELECT COUNT(*) FROM cust) AS total_customers,
        (SELECT COUNT(DISTINCT order_id) FROM hdr) AS total_orders,
        (SELECT category FROM {CATEGORY} ORDER BY rev DESC, category LIMIT 1) AS best_category,
        (SELECT category FROM {CATEGORY} ORDER BY rev, category LIMIT 1) AS worst_category,
        (SELECT store_region FROM {REGION} ORDER BY rev DESC, store_region LIMIT 1) AS best_region,
        (SELECT store_region FROM {REGION} ORDER BY rev, store_region LIMIT 1) AS worst_region""")
add("b07_first_pass_segments", lambda t: reports.first_pass_segments(t.segments),
    f"SELECT segment, COUNT(*) AS customers, {even(div('COUNT(*)', 'SUM(COUNT(*)) OVER ()') + ' * 100', 1)} AS pct FROM segs GROUP BY segment")
add("b07_first_pass_risk", lambda t: rounded(reports.first_pass_risk(t.predictions), "avg_churn_probability"),
    f"SELECT COUNT(*) FILTER (p10k >= 7000) AS high_risk_count, {r6(div('SUM(p10k)', 'COUNT(*)') + ' / 10000')} AS avg_churn_probability FROM preds")
EXTRACT = f"""SELECT order_id, date_key AS order_date, {int_('YEAR(date_key)')} AS order_year, {int_('MONTH(date_key)')} AS order_month,
        MONTHNAME(date_key) AS order_month_name, customer_id, s.product_id, product_name, category, subcategory, brand, quantity,
        {dbl('s.unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total,
        {dbl('(s.unit_price - unit_cost) * quantity * (1 - discount)')} AS gross_margin, payment_method, channel, store_region AS region
        FROM sales s LEFT JOIN prod p ON p.product_id = s.product_id"""
add("b08_sales_extract", lambda t: plain(extracts.sales_extract(t.items, t.orders, t.products)), EXTRACT)
add("b08_extract_by_buckets", lambda t: plain(
    extracts.extract_from_lines(with_headers(t.placed, "inner", extracts.HEADER_COLUMNS), t.products)), EXTRACT)
WIDE = """cust c LEFT JOIN feat f USING (customer_id) LEFT JOIN segs g USING (customer_id) LEFT JOIN preds p USING (customer_id)"""
PROFILE = "customer_id, c.name, c.email, c.gender, c.age, c.city, c.state, c.region, c.signup_date, c.loyalty_tier, c.loyalty_points"
BEHAVIOUR = """f.customer_tenure_days, f.recency_days, f.frequency, f.monetary, f.avg_order_value, f.total_items_purchased, f.unique_products_purchased,
    f.unique_categories_purchased, f.average_discount, f.purchase_trend_ratio, f.loyalty_tier_encoded, g.segment, p.churn_probability"""
add("b09_customer_extract", lambda t: plain(extracts.customer_extract(t.customers, t.features, t.segments, t.predictions)),
    f"SELECT {PROFILE}, {BEHAVIOUR}, {RISK} AS churn_risk_band FROM {WIDE}")
add("b10_risk_bands", lambda t: t.customers.select("customer_id").join(t.predictions, "customer_id", "left").groupBy(
        extracts.risk_band(F.col("churn_probability")).alias("band")).agg(F.count(F.lit(1)).alias("customers")),
    f"SELECT {RISK} AS band, COUNT(*) AS customers FROM cust LEFT JOIN preds USING (customer_id) GROUP BY 1")
add("b11_sales_detail", lambda t: plain(extracts.sales_detail(t.items, t.orders, t.products)),
    f"""SELECT order_id, customer_id, date_key AS order_date, s.product_id, product_name, category, subcategory, brand, quantity,
        {dbl('s.unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total, payment_method, channel, store_region
        FROM sales s JOIN prod p ON p.product_id = s.product_id""")
add("b12_customer_360", lambda t: plain(extracts.customer_360(t.customers, t.features, t.segments, t.predictions)),
    f"""SELECT {PROFILE}, f.loyalty_tier AS loyalty_tier_feat, f.loyalty_points AS loyalty_points_feat, f.region AS region_feat,
        f.age AS age_feat, f.gender AS gender_feat, {BEHAVIOUR} FROM {WIDE}""")


def _read_back(t, bundle):
    folder = staging_path(t.spark, "bundle")
    io.write_bundle(bundle, folder)
    return differences({n: (df, t.spark.read.parquet(f"{folder}/{n}")) for n, df in bundle.items()})


add("b13_extract_copies", lambda t: _read_back(t, extracts.extract_bundle(
        t.customers, t.products, t.orders, t.items, t.features, t.segments, t.predictions)),
    " UNION ALL ".join(f"SELECT '{n}' AS source, COUNT(*) AS rows, CAST(0 AS BIGINT) AS differences FROM {v}" for n, v in {
        "sales_dashboard": "sales", "customer_dashboard": "cust", "sales_detail": "sales", "customer_360": "cust", "customers": "cust",
        "products": "prod", "orders": "ord", "dim_date": "cal", "customer_segments": "segs", "churn_predictions": "preds"}.items()))
add("b14_report_bundle", lambda t: _read_back(t, reports.report_bundle(t.customers, t.products, t.orders, t.items, t.segments, t.predictions)),
    f"""SELECT *, CAST(0 AS BIGINT) AS differences FROM (SELECT * FROM (VALUES ('headline', 1::BIGINT), ('churn_summary', 1), ('bottom_products', 5)) v(source, rows)
        UNION ALL SELECT 'segment_summary', COUNT(DISTINCT segment) FROM segs UNION ALL SELECT 'category_performance', COUNT(DISTINCT category) FROM prod
        UNION ALL SELECT 'regional_performance', COUNT(DISTINCT store_region) FROM sales UNION ALL SELECT 'high_risk', COUNT(*) FROM preds WHERE p10k >= 6000
        UNION ALL SELECT 'retention_targets', COUNT(*) FROM (SELECT *, {div('SUM(monetary) OVER (PARTITION BY segment)', 'COUNT(*) OVER (PARTITION BY segment)')} AS m FROM segs)
        JOIN preds USING (customer_id) WHERE CAST(monetary AS DOUBLE) > m AND p10k >= 6000)""")

# --- K: measures ---

MODEL = f"""(SELECT sales.*, region, loyalty_tier, segment, CAST(YEAR(date_key) AS INTEGER) AS year, CAST(MONTH(date_key) AS INTEGER) AS month
             FROM sales JOIN cust USING (customer_id) LEFT JOIN segs USING (customer_id))"""


def _model(t):
    return measures.sales_model(t.sales_lean, t.customers, t.segments)


def _customer_model(t):
    return t.customers.join(t.segments.select("customer_id", "segment", "monetary"), "customer_id", "left").join(
        t.predictions.select("customer_id", "churn_probability"), "customer_id", "left")


CUSTOMER_MODEL = "(SELECT * FROM cust LEFT JOIN segs USING (customer_id) LEFT JOIN preds USING (customer_id))"


def _sales_measure(key, measure, expression, name):
    add(key, lambda t: measure(t.sales_lean), f"SELECT {expression} AS {name} FROM sales")
    add(f"{key}_by_tier", lambda t: measure(_model(t), ["loyalty_tier"]), f"SELECT loyalty_tier, {expression} AS {name} FROM {MODEL} GROUP BY loyalty_tier")


_sales_measure("k01_total_revenue", measures.total_revenue, dbl("SUM(line_total)"), "total_revenue")
_sales_measure("k02_total_orders", measures.total_orders, "COUNT(DISTINCT order_id)", "total_orders")
_sales_measure("k03_total_customers", measures.total_customers, "COUNT(DISTINCT customer_id)", "total_customers")
_sales_measure("k04_average_order_value", measures.average_order_value, f"COALESCE({div('SUM(line_total)', 'COUNT(DISTINCT order_id)')}, 0)", "average_order_value")
add("k05_repeat_customer_rate", lambda t: measures.repeat_customer_rate(t.sales_lean),
    f"SELECT {div('COUNT(*) FILTER (n > 1)', 'COUNT(*)')} AS repeat_customer_rate FROM {PER_CUSTOMER}")
add("k05_repeat_rate_by_channel", lambda t: measures.repeat_customer_rate(t.sales_lean, ["channel"]),
    f"""SELECT channel, {div('COUNT(*) FILTER (n > 1)', 'COUNT(*)')} AS repeat_customer_rate
        FROM (SELECT channel, customer_id, COUNT(DISTINCT order_id) AS n FROM sales GROUP BY ALL) GROUP BY channel""")
add("k06_growth_by_calendar", lambda t: measures.growth_by_calendar(t.sales_lean),
    f"""SELECT m AS month_start, {dbl('a.rev')} AS revenue, {dbl('b.rev')} AS prior_revenue, {div('a.rev - b.rev', 'b.rev')} AS mom_revenue_growth
        FROM (SELECT CAST(DATE_TRUNC('month', date_key) AS DATE) AS m, SUM(line_total) AS rev FROM sales GROUP BY 1) a LEFT JOIN
             (SELECT CAST(DATE_TRUNC('month', date_key) + INTERVAL 1 MONTH AS DATE) AS m, SUM(line_total) AS rev FROM sales GROUP BY 1) b USING (m)""")
_sales_measure("k07_average_discount", measures.average_discount, div("SUM(discount)", "COUNT(discount)"), "average_discount")
add("k08_high_risk_customers", lambda t: measures.high_risk_customers(_customer_model(t)), "SELECT COUNT(DISTINCT customer_id) AS high_risk_customers FROM preds WHERE p10k >= 6000")
add("k08_high_risk_by_segment", lambda t: measures.high_risk_customers(_customer_model(t), ["segment"]),
    f"SELECT segment, COUNT(DISTINCT customer_id) FILTER (p10k >= 6000) AS high_risk_customers FROM {CUSTOMER_MODEL} GROUP BY segment")
add("k09_average_churn_probability", lambda t: rounded(measures.average_churn_probability(_customer_model(t)), "average_churn_probability"),
    f"SELECT {r6(div('SUM(p10k)', 'COUNT(*)') + ' / 10000')} AS average_churn_probability FROM preds")
_sales_measure("k10_revenue_per_customer", measures.revenue_per_customer, f"COALESCE({div('SUM(line_total)', 'COUNT(DISTINCT customer_id)')}, 0)", "revenue_per_customer")
add("k11_calendar", lambda t: date_dimension(t.sales_lean, "date_key").select("date_key"), "SELECT CAST(UNNEST(GENERATE_SERIES(MIN(date_key), MAX(date_key), INTERVAL 1 DAY)) AS DATE) AS date_key FROM sales")

add("k12_slicer_cube", lambda t: measures.slicer_cube(_model(t), ["year", "region", "loyalty_tier", "channel"]),
    f"SELECT year, region, loyalty_tier, channel, {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders FROM {MODEL} GROUP BY CUBE (year, region, loyalty_tier, channel)")
add("k12_all_slicers", lambda t: measures.slicer_cube(_model(t), ["year", "month", "region", "loyalty_tier", "segment", "channel"]),
    f"SELECT year, month, region, loyalty_tier, segment, channel, {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders FROM {MODEL} GROUP BY CUBE (year, month, region, loyalty_tier, segment, channel)")
add("k12_sliced", lambda t: measures.total_revenue(measures.sliced(_model(t), {"region": ["ASIA", "EUROPE"], "segment": "Champions", "year": 2000}), ["month"]),
    f"SELECT month, {dbl('SUM(line_total)')} AS total_revenue FROM {MODEL} WHERE region IN ('ASIA', 'EUROPE') AND segment = 'Champions' AND year = 2000 GROUP BY month")
add("k13_revenue_by_region", lambda t: measures.revenue_by(t.sales, "store_region"), f"SELECT store_region, {dbl('SUM(line_total)')} AS total_revenue FROM sales GROUP BY store_region")
add("k13_top_products", lambda t: measures.top_products(t.sales_lean, t.products), f"SELECT product_id, product_name, {dbl('rev')} AS total_revenue FROM {PRODUCTS} ORDER BY rev DESC, product_id LIMIT 10")
add("k13_revenue_and_orders", lambda t: measures.revenue_and_orders_by_month(t.sales_lean),
    f"SELECT {int_('YEAR(date_key)')} AS year, {int_('MONTH(date_key)')} AS month, {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders FROM sales GROUP BY 1, 2")
add("k13_segment_distribution", lambda t: measures.segment_distribution(_customer_model(t)), "SELECT segment, COUNT(*) AS customers FROM segs GROUP BY segment")
add("k13_spend_by_tier", lambda t: measures.spend_by_tier(_customer_model(t)),
    f"SELECT loyalty_tier, {div('SUM(monetary)', 'COUNT(*)')} AS avg_monetary FROM {CUSTOMER_MODEL} GROUP BY loyalty_tier")
add("k13_at_risk", lambda t: measures.at_risk_table(_customer_model(t)), f"SELECT customer_id, name, segment, churn_probability FROM {CUSTOMER_MODEL} WHERE p10k >= 6000")
add("k13_probability_bins", lambda t: measures.probability_distribution(_customer_model(t)),
    f"SELECT {big('LEAST(p10k // 1000, 9)')} AS bin, COUNT(*) AS customers FROM preds GROUP BY 1")

# --- N: exploration ---

add("n01_shapes", lambda t: explore.table_shapes({"customers": t.customers, "products": t.products, "orders": t.orders, "order_items": t.items}),
    " UNION ALL ".join(f"SELECT '{n}' AS \"table\", COUNT(*) AS rows, CAST({c} AS INTEGER) AS columns FROM {v}" for n, v, c in (
        ("customers", "cust", 11), ("products", "prod", 7), ("orders", "ord", 7), ("order_items", "itm", 6))))
add("n02_by_region", lambda t: explore.customers_by_region(t.customers), "SELECT region, COUNT(*) AS customers FROM cust GROUP BY region")
add("n02_by_tier", lambda t: explore.customers_by_tier(t.customers), "SELECT loyalty_tier, COUNT(*) AS customers FROM cust WHERE loyalty_tier <> 'Unknown' GROUP BY loyalty_tier")
add("n03_revenue_by_category", lambda t: explore.revenue_by_category(t.items, t.products), f"SELECT category, {dbl('rev')} AS revenue FROM {CATEGORY}")
add("n04_score_frequencies", lambda t: explore.score_frequencies(t.scores),
    "SELECT CAST(r_s AS VARCHAR) || CAST(f_s AS VARCHAR) || CAST(m_s AS VARCHAR) AS \"RFM_score\", COUNT(*) AS customers FROM scores GROUP BY 1 ORDER BY 1 LIMIT 20")
add("n05_tier_summary", lambda t: explore.tier_summary(t.features),
    f"""SELECT loyalty_tier, COUNT(*) AS customers, {div('SUM(r.monetary)', 'COUNT(*)')} AS avg_monetary, {div('SUM(r.frequency)', 'COUNT(*)')} AS avg_frequency,
        {div('SUM(r.recency_days)', 'COUNT(*)')} AS avg_recency FROM cust JOIN rfm r USING (customer_id) WHERE loyalty_tier <> 'Unknown' GROUP BY loyalty_tier""")
add("n06_inactivity_bands", lambda t: explore.inactivity_bands(t.features),
    """SELECT inactivity_bucket, customers FROM (VALUES ('0-30 days'), ('31-90 days'), ('91-180 days'), ('181-365 days'), ('365+ days')) v(inactivity_bucket)
       LEFT JOIN (SELECT CASE WHEN recency_days <= 30 THEN '0-30 days' WHEN recency_days <= 90 THEN '31-90 days' WHEN recency_days <= 180 THEN '91-180 days'
                  WHEN recency_days <= 365 THEN '181-365 days' ELSE '365+ days' END AS inactivity_bucket, COUNT(*) AS customers FROM rfm GROUP BY 1) USING (inactivity_bucket)""")
add("n07_tenure_frequency_grid", lambda t: binned_pairs(t.features, "customer_tenure_days", "frequency"),
    f"""SELECT {big('LEAST((x - x0) * 20 // (x1 - x0), 19)')} AS x_bin, {big('LEAST((y - y0) * 20 // (y1 - y0), 19)')} AS y_bin, COUNT(*) AS points
        FROM (SELECT x, y, MIN(x) OVER () AS x0, MAX(x) OVER () AS x1, MIN(y) OVER () AS y0, MAX(y) OVER () AS y1
              FROM (SELECT CAST(customer_tenure_days AS BIGINT) AS x, frequency AS y FROM feat)) GROUP BY 1, 2""")
add("n07_tenure_frequency_corr", lambda t: rounded(explore.tenure_frequency_correlation(t.features), "correlation"),
    f"SELECT {r6('CORR(customer_tenure_days, frequency)')} AS correlation FROM feat")

# --- X: lists the report recommends ---

SEGMENT_MEAN = f"(SELECT *, {div('SUM(monetary) OVER (PARTITION BY segment)', 'COUNT(*) OVER (PARTITION BY segment)')} AS m FROM segs)"
add("x01_high_risk_export", lambda t: reports.high_risk_export(t.predictions), "SELECT customer_id, churn_probability FROM preds WHERE p10k >= 6000")
add("x02_retention_targets", lambda t: plain(reports.retention_targets(t.segments, t.predictions)),
    f"""SELECT customer_id, segment, {dbl('monetary')} AS monetary, m AS segment_avg_monetary, churn_probability
        FROM {SEGMENT_MEAN} JOIN preds USING (customer_id) WHERE CAST(monetary AS DOUBLE) > m AND p10k >= 6000""")


def _band(rfm):
    return rfm.select("customer_id", F.when(F.col("recency_days") <= 90, "active").otherwise("idle").alias("segment"))


def _migration(t, how=reports.segment_migration):
    """Snapshots at the cutoff and at the end of the label window, each of the customers signed up by then."""
    signed = [t.customers.where(F.col("signup_date") <= F.lit(d)) for d in ("2000-05-03", str(t.obs_end))]
    before = _band(build_rfm_features(signed[0], t.headers, t.cutoff))
    after = _band(build_rfm_features(signed[1], t.headers, t.obs_end))
    return how(before, after)


def _snapshot(signed: str, as_of: str) -> str:
    return f"""(SELECT customer_id, CASE WHEN {as_of} - COALESCE((SELECT MAX(order_date) FROM hdr h WHERE h.customer_id = c.customer_id AND order_date <= {as_of}),
                signup_date) <= 90 THEN 'active' ELSE 'idle' END AS s FROM cust c WHERE signup_date <= {signed})"""


MIGRATION = f"""SELECT a.s AS from_segment, b.s AS to_segment, COUNT(*) AS customers FROM {_snapshot("DATE '2000-05-03'", CUT)} a
        FULL JOIN {_snapshot(END, END)} b USING (customer_id) GROUP BY 1, 2"""
add("x03_segment_migration", _migration, MIGRATION)
add("x03_migration_by_ranges", lambda t: _migration(t, reports.segment_migration_by_ranges), MIGRATION)
add("x04_category_by_region", lambda t: reports.category_by_region(t.sales, t.products),
    f"SELECT category, store_region, {dbl('SUM(line_total)')} AS revenue FROM sales JOIN prod USING (product_id) GROUP BY CUBE (category, store_region)")
add("x04_category_region_matrix", lambda t: reports.category_region_matrix(t.sales, t.products, REGIONS),
    "SELECT category, " + ", ".join(f"""{dbl(f"SUM(line_total) FILTER (store_region = '{r}')")} AS "{r}\"""" for r in REGIONS)
    + " FROM sales JOIN prod USING (product_id) GROUP BY category")


def _dependent_sql(by):
    return f"""SELECT {by}, {dbl('rev')} AS revenue, {even('CAST(rev AS DOUBLE) / CAST(s AS DOUBLE) * 100', 4)} AS pct_of_revenue, {even('d', 6)} AS avg_discount
        FROM (SELECT {by}, rev, {div('disc', 'n')} AS d, SUM(rev) OVER () AS s, COUNT(*) OVER () AS k, {div('SUM(disc) OVER ()', 'SUM(n) OVER ()')} AS whole
              FROM (SELECT {by}, SUM(line_total) AS rev, SUM(discount) AS disc, COUNT(discount) AS n FROM itm JOIN prod USING (product_id) GROUP BY {by}))
        WHERE CAST(rev AS DOUBLE) * k < CAST(s AS DOUBLE) AND d > whole"""


add("x05_discount_dependent_products", lambda t: reports.discount_dependent(t.items, t.products, "product_id"), _dependent_sql("product_id"))
add("x05_discount_dependent_categories", lambda t: reports.discount_dependent(t.items, t.products), _dependent_sql("category"))
add("x06_loyal_at_half", lambda t: reports.loyal_at_risk(t.segments, t.predictions.withColumn("churn_probability", F.bround(F.least(F.col("churn_probability") + 0.35, F.lit(1.0)), 4))),
    """SELECT customer_id, segment, LEAST(p10k + 3500, 10000) / 10000.0::DOUBLE AS churn_probability FROM segs JOIN preds USING (customer_id)
       WHERE segment IN ('Champions', 'Loyal Customers') AND LEAST(p10k + 3500, 10000) > 5000""")
add("x06_loyal_at_risk", lambda t: reports.loyal_at_risk(t.segments, t.predictions, threshold=0.2),
    "SELECT customer_id, segment, churn_probability FROM segs JOIN preds USING (customer_id) WHERE segment IN ('Champions', 'Loyal Customers') AND p10k > 2000")

"""Checks of cleaning, features and the business questions (C, L, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.catalog import add
from checks.oracle import CUT, END, big, cents, dbl, div, hup, int_
from checks.tables import plain
from ledgerlark.operators import cleaning, features, star
from ledgerlark.operators.colocated import with_headers, with_sums
from ledgerlark.plans import business, measures
from ledgerlark.sources.driver_tables import REFERENCE_DATE

# --- C: cleaning, on the tables with defects ---

CHECKS = {
    "c01_duplicate_customers": [1], "c02_null_customer_ids": [2], "c03_missing_text": [3, 4, 5, 6, 7, 8],
    "c04_invalid_age": [9], "c05_negative_points": [10], "c06_bad_signup_dates": [11], "c07_unknown_tiers": [12],
    "c08_duplicate_products": [13], "c09_null_product_ids": [14], "c10_invalid_prices": [15], "c11_invalid_costs": [16],
    "c12_duplicate_orders": [17], "c13_orphan_customers": [18], "c14_bad_order_dates": [19], "c15_negative_totals": [20],
    "c16_orphan_orders": [21], "c17_orphan_products": [22], "c18_invalid_quantities": [23], "c19_invalid_line_totals": [24],
    "c20_discount_range": [25], "c21_reconcile_totals": [26], "c22_empty_orders": [27],
}


def _report(t, numbers):
    """The part of the report a check comes from, so that no other table is read."""
    if max(numbers) <= 12:
        report = t.cleaned_customers.report
    elif max(numbers) <= 16:
        report = t.cleaned_products.report
    else:
        orders, items = t.cleaned_orders
        report = items.report if 21 <= min(numbers) <= 25 else orders.report
    return report.where(F.col("seq").isin(numbers))


for name, numbers in CHECKS.items():
    add(name, lambda t, n=numbers: _report(t, n), f"SELECT * FROM quality WHERE seq IN ({', '.join(map(str, numbers))})")



def _timestamp_headers(t):
    """The same orders with their dates as timestamps; what is no date is null."""
    stamped = t.dirty_orders.withColumn("order_date", F.try_to_timestamp(F.concat("order_date", F.lit(" 08:15:00"))))
    orders, _ = cleaning.clean_orders_and_items(stamped, t.dirty_items, t.cleaned_customers.rows, t.cleaned_products.rows, ["arrival"])
    return plain(orders.rows)


add("c14_timestamp_headers", _timestamp_headers, f"SELECT * REPLACE ({dbl('total_amount')} AS total_amount) FROM cord")
add("c23_quality_report", lambda t: t.quality, "SELECT * FROM quality")
add("c23_total_issues", lambda t: cleaning.total_issues(t.quality), f"SELECT {big('SUM(issue_count)')} AS total_issues FROM quality")
add("c00_clean_customers", lambda t: t.cleaned_customers.rows, "SELECT * FROM ccust")
add("c00_clean_products", lambda t: plain(t.cleaned_products.rows),
    f"SELECT * REPLACE ({dbl('unit_cost')} AS unit_cost, {dbl('unit_price')} AS unit_price) FROM cprod")
add("c00_clean_orders", lambda t: plain(t.cleaned_orders[0].rows), f"SELECT * REPLACE ({dbl('total_amount')} AS total_amount) FROM cord")
add("c00_clean_items", lambda t: plain(t.cleaned_orders[1].rows),
    f"SELECT * REPLACE ({dbl('unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total) FROM citm")

# --- L: features ---

RFM_SQL = f"SELECT customer_id, recency_days, frequency, {dbl('monetary')} AS monetary, avg_order_value FROM rfm"
SCORE_SQL = 'r_s AS "R_score", f_s AS "F_score", m_s AS "M_score"'

add("l01_rfm", lambda t: plain(t.rfm), RFM_SQL)
add("l02_purchase_dates", lambda t: features.purchase_dates(t.headers, t.cutoff),
    "SELECT customer_id, first_day AS first_purchase_date, last_day AS last_purchase_date FROM stats")
add("l03_quintile_scores", lambda t: t.scores.select("customer_id", "F_score", "M_score"),
    'SELECT customer_id, f_s AS "F_score", m_s AS "M_score" FROM scores')
add("l04_reverse_recency_score", lambda t: t.scores.select("customer_id", "recency_days", "R_score"),
    'SELECT customer_id, recency_days, r_s AS "R_score" FROM scores')
add("l05_rfm_text", lambda t: plain(t.scores),
    f"SELECT customer_id, recency_days, frequency, {dbl('monetary')} AS monetary, avg_order_value, {SCORE_SQL}, "
    "CAST(r_s AS VARCHAR) || CAST(f_s AS VARCHAR) || CAST(m_s AS VARCHAR) AS \"RFM_score\" FROM scores")
add("l06_tenure", lambda t: features.tenure(t.customers, t.cutoff), "SELECT customer_id, customer_tenure_days FROM feat")
add("l07_basket", lambda t: features.basket_stats(t.headers, t.items, t.products, t.cutoff),
    f"SELECT customer_id, {big('units')} AS total_items_purchased, products AS unique_products_purchased, "
    "categories AS unique_categories_purchased, avg_discount AS average_discount FROM basket")
add("l08_trend_ratio", lambda t: features.order_stats(t.headers, t.cutoff).select("customer_id", features.trend_ratio().alias("purchase_trend_ratio")),
    "SELECT customer_id, purchase_trend_ratio FROM feat JOIN stats USING (customer_id)")
add("l09_tier_code", lambda t: t.features.select("customer_id", "loyalty_tier", "loyalty_tier_encoded"),
    "SELECT customer_id, loyalty_tier, loyalty_tier_encoded FROM feat")
add("l10_customer_features", lambda t: plain(t.features), "SELECT * FROM feat")
add("l11_churn_labels", lambda t: t.labels, "SELECT * FROM churnlab")
add("l12_churn_dataset", lambda t: plain(t.churnset), "SELECT * FROM churnset")
add("l12_churn_rate", lambda t: features.churn_rate(t.churnset),
    f"SELECT COUNT(*) AS customers, {div('SUM(churned)', 'COUNT(*)')} AS churn_rate FROM churnlab")


def _study_dates(t):
    cutoff, end = features.study_dates(REFERENCE_DATE)
    day = F.col("order_date")
    return t.headers.agg(
        F.count_if(day <= F.lit(cutoff)).alias("before"),
        F.count_if((day > F.lit(cutoff)) & (day <= F.lit(end))).alias("observed"),
    )


add("l13_date_windows", _study_dates,
    f"SELECT COUNT(*) FILTER (order_date <= {CUT}) AS before, COUNT(*) FILTER (order_date > {CUT} AND order_date <= {END}) AS observed FROM hdr")

# --- D: business questions on the star ---

MONTHS = """(SELECT CAST(YEAR(date_key) AS INTEGER) AS year, CAST(MONTH(date_key) AS INTEGER) AS month, SUM(line_total) AS rev,
             COUNT(DISTINCT order_id) AS n FROM sales GROUP BY 1, 2)"""
PRODUCTS = """(SELECT p.product_id, ANY_VALUE(product_name) AS product_name, ANY_VALUE(category) AS category, SUM(line_total) AS rev,
               CAST(SUM(quantity) AS BIGINT) AS units_sold FROM sales s JOIN prod p ON p.product_id = s.product_id GROUP BY p.product_id)"""
PER_CUSTOMER = "(SELECT customer_id, SUM(line_total) AS rev, COUNT(DISTINCT order_id) AS n, MAX(date_key) AS last_day FROM sales GROUP BY customer_id)"


def aov(num="SUM(line_total)", den="COUNT(DISTINCT order_id)"):
    return hup(cents(num), f"{den} * 100")


def _by_revenue(direction: str) -> str:
    return (f"SELECT product_id, product_name, category, {dbl('rev')} AS revenue, units_sold FROM {PRODUCTS} "
            f"ORDER BY rev {direction}, product_id LIMIT 20")


add("d01_total_revenue", lambda t: business.total_revenue(t.sales_lean),
    f"SELECT {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers FROM sales")
# Some lines of an order under another customer and region, as in a fact of uncleaned tables.
SPLIT_ORDERS = """(SELECT * REPLACE (CASE WHEN (order_id * 7 + product_id) % 50 = 0 THEN 1 ELSE customer_id END AS customer_id,
                   CASE WHEN (order_id * 7 + product_id) % 50 = 0 THEN 'ASIA' ELSE store_region END AS store_region) FROM sales)"""


def _split_orders(t):
    moved = (F.col("order_id") * 7 + F.col("product_id")) % 50 == 0
    return t.sales.withColumns({
        "customer_id": F.when(moved, F.lit(1).cast("long")).otherwise(F.col("customer_id")),
        "store_region": F.when(moved, "ASIA").otherwise(F.col("store_region")),
    })


add("d01_split_orders", lambda t: business.total_revenue(_split_orders(t)),
    f"SELECT {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers FROM {SPLIT_ORDERS}")
add("d07_split_orders", lambda t: business.regional_performance(_split_orders(t)),
    f"""SELECT store_region, {dbl('SUM(line_total)')} AS revenue, COUNT(DISTINCT order_id) AS orders,
        COUNT(DISTINCT customer_id) AS customers, {aov()} AS avg_order_value FROM {SPLIT_ORDERS} GROUP BY store_region""")
add("k12_split_orders", lambda t: measures.slicer_cube(_split_orders(t), ["store_region", "channel"]),
    f"SELECT store_region, channel, {dbl('SUM(line_total)')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders FROM {SPLIT_ORDERS} GROUP BY CUBE (store_region, channel)")
add("d02_monthly_revenue", lambda t: business.monthly_revenue(t.sales_lean),
    f"SELECT year, month, MONTHNAME(MAKE_DATE(year, month, 1)) AS month_name, {dbl('rev')} AS monthly_revenue, n AS monthly_orders FROM {MONTHS}")
add("d03_mom_growth", lambda t: business.month_over_month(t.sales_lean),
    f"""SELECT year, month, {dbl('rev')} AS revenue, {dbl('prev')} AS prev_month_revenue,
        CASE WHEN prev IS NOT NULL THEN {hup('(rev - prev) * 10000', 'prev * 100')} END AS mom_growth_pct
        FROM (SELECT *, LAG(rev) OVER (ORDER BY year, month) AS prev FROM {MONTHS})""")
add("d04_top_products", lambda t: business.top_products(t.sales_lean, t.products), _by_revenue("DESC"))
add("d05_bottom_products", lambda t: business.bottom_products(t.sales_lean, t.products), _by_revenue("ASC"))
add("d06_category_performance", lambda t: business.category_performance(t.sales_lean, t.products),
    f"""SELECT category, {dbl('rev')} AS revenue, units AS units_sold, {hup('rev * 10000', 'SUM(rev) OVER () * 100')} AS pct_of_total_revenue
        FROM (SELECT category, SUM(rev) AS rev, CAST(SUM(units_sold) AS BIGINT) AS units FROM {PRODUCTS} GROUP BY category)""")
add("d07_regional_performance", lambda t: business.regional_performance(t.sales),
    f"""SELECT store_region, {dbl('SUM(line_total)')} AS revenue, COUNT(DISTINCT order_id) AS orders,
        COUNT(DISTINCT customer_id) AS customers, {aov()} AS avg_order_value FROM sales GROUP BY store_region""")
add("d08_lifetime_value", lambda t: business.lifetime_value(t.sales_lean, t.customers),
    f"""SELECT customer_id, name, loyalty_tier, {dbl('rev')} AS lifetime_value, n AS total_orders
        FROM {PER_CUSTOMER} JOIN cust USING (customer_id) ORDER BY rev DESC, customer_id LIMIT 25""")
add("d09_repeat_rate", lambda t: business.repeat_rate(t.sales_lean),
    f"""SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (n > 1) AS repeat_customers,
        {hup('COUNT(*) FILTER (n > 1) * 100', 'COUNT(*)')} AS repeat_customer_rate_pct FROM {PER_CUSTOMER}""")
add("d10_order_value_by_channel", lambda t: business.order_value_by_channel(t.sales_lean),
    f"SELECT channel, {aov()} AS avg_order_value, COUNT(DISTINCT order_id) AS orders FROM sales GROUP BY channel")
add("d10_order_value_with_total", lambda t: business.order_value_by_channel(t.sales_lean, with_total=True),
    f"SELECT channel, {aov()} AS avg_order_value, COUNT(DISTINCT order_id) AS orders FROM sales GROUP BY ROLLUP (channel)")
add("d11_tier_performance", lambda t: business.tier_performance(t.customers, t.sales_lean),
    f"""SELECT loyalty_tier, COUNT(*) AS customers, {dbl('SUM(rev)')} AS revenue, {aov('SUM(rev)', 'COUNT(*)')} AS revenue_per_customer
        FROM cust LEFT JOIN {PER_CUSTOMER} USING (customer_id) GROUP BY loyalty_tier""")
add("d12_inactivity", lambda t: business.inactivity_buckets(t.sales_lean),
    f"""SELECT CASE WHEN gap <= 30 THEN '0-30 days' WHEN gap <= 90 THEN '31-90 days' WHEN gap <= 180 THEN '91-180 days'
        ELSE '180+ days' END AS inactivity_bucket, COUNT(*) AS customers
        FROM (SELECT MAX(last_day) OVER () - last_day AS gap FROM {PER_CUSTOMER}) GROUP BY 1""")
add("d13_cumulative_revenue", lambda t: business.cumulative_revenue(t.sales_lean),
    f"SELECT year, month, {dbl('rev')} AS monthly_revenue, {dbl('SUM(rev) OVER (ORDER BY year, month)')} AS cumulative_revenue FROM {MONTHS}")
add("d14_top_customers_per_region", lambda t: business.top_customers_per_region(t.sales_lean, t.customers),
    f"""SELECT region, customer_id, name, {dbl('rev')} AS revenue, {int_('place')} AS region_rank
        FROM (SELECT *, RANK() OVER (PARTITION BY region ORDER BY rev DESC) AS place FROM {PER_CUSTOMER} JOIN cust USING (customer_id))
        WHERE place <= 5""")
add("d15_order_frequency", lambda t: business.order_count_buckets(t.sales_lean),
    f"""SELECT CASE WHEN n = 1 THEN '1 order' WHEN n <= 3 THEN '2-3 orders' WHEN n <= 6 THEN '4-6 orders' ELSE '7+ orders' END
        AS frequency_bucket, COUNT(*) AS customers FROM {PER_CUSTOMER} GROUP BY 1""")
add("d16_payment_methods", lambda t: business.payment_methods(t.sales_lean),
    f"SELECT payment_method, COUNT(DISTINCT order_id) AS orders, {aov()} AS avg_order_value FROM sales GROUP BY payment_method")
add("d17_discount_impact", lambda t: business.discount_impact(t.sales_lean),
    f"""SELECT CASE WHEN discount = 0 THEN 'No discount' WHEN discount <= 0.1 THEN '1-10%' WHEN discount <= 0.2 THEN '11-20%'
        ELSE '20%+' END AS discount_band, COUNT(*) AS line_items, {big('SUM(quantity)')} AS units_sold,
        {hup('SUM(quantity)', 'COUNT(quantity)')} AS avg_qty_per_line FROM sales GROUP BY 1""")
add("d18_date_dimension", lambda t: star.date_dimension(t.headers), "SELECT * FROM cal")
add("d19_sales_fact", lambda t: plain(t.sales),
    f"SELECT * REPLACE ({dbl('unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total) FROM sales")

add("d19_fact_by_buckets", lambda t: plain(star.fact_from_lines(with_headers(t.placed, "inner", star.HEADER_CONTEXT))),
    f"SELECT * REPLACE ({dbl('unit_price')} AS unit_price, {dbl('discount')} AS discount, {dbl('line_total')} AS line_total) FROM sales")
add("c21_totals_by_buckets", lambda t: plain(
    with_sums(t.placed, lines=F.count(F.lit(1)), line_sum=F.sum("line_total")).select("order_id", "total_amount", "lines", "line_sum")),
    f"""SELECT order_id, {dbl('total_amount')} AS total_amount, lines, {dbl('line_sum')} AS line_sum FROM ord
        LEFT JOIN (SELECT order_id, COUNT(*) AS lines, SUM(line_total) AS line_sum FROM itm GROUP BY order_id) USING (order_id)""")


def _audit(t):
    """The audit of the uncleaned tables, which has something to find."""
    dirty = star.sales_fact(t.dirty_items, t.dirty_orders.withColumn("order_date", F.try_to_date("order_date", "yyyy-MM-dd")))
    return star.constraint_audit(
        t.dirty_customers.drop("arrival"), t.dirty_products.drop("arrival"), star.date_dimension(t.headers), dirty
    )


def _audit_sql() -> str:
    fact = """(SELECT i.order_id, o.customer_id, i.product_id, TRY_CAST(o.order_date AS DATE) AS date_key, i.quantity, i.unit_price,
               i.discount, i.line_total, o.payment_method, o.channel, o.store_region FROM ditm i JOIN dord o ON o.order_id = i.order_id) f"""
    parts = []
    columns = {
        "dim_customer": ("dcust", ["customer_id", "name", "email", "gender", "age", "city", "state", "region", "signup_date", "loyalty_tier", "loyalty_points"]),
        "dim_product": ("dprod", ["product_id", "product_name", "category", "subcategory", "brand", "unit_cost", "unit_price"]),
        "dim_date": ("cal", ["date_key", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name", "is_weekend"]),
        "fact_sales": (fact, star.FACT_COLUMNS),
    }
    for table, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_date", "date_key")):
        source = columns[table][0]
        parts.append(f"""SELECT '{table}' AS "table", 'primary key {key}' AS rule, CAST(SUM(n - 1) AS BIGINT) AS violations
                         FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {key})""")
        parts.append(f"""SELECT 'fact_sales', 'foreign key {key}', COUNT(*) FROM {fact}
                         WHERE NOT EXISTS (SELECT 1 FROM {source} d WHERE d.{key} = f.{key})""")
    for table, (source, names) in columns.items():
        parts += [f"SELECT '{table}', 'not null {c}', COUNT(*) FROM {source} WHERE {c} IS NULL" for c in names]
    return " UNION ALL ".join(parts)


add("d20_constraint_audit", _audit, _audit_sql())

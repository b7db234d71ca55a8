"""Building blocks of the DuckDB side: the same views as `DriverTables`, as common table expressions."""

from __future__ import annotations

import re

CUT = "DATE '2001-05-03'"
END = "DATE '2001-08-01'"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def int_(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def hup(num: str, den: str, places: int = 2) -> str:
    """Exact half-up rounding of a quotient of whole numbers (positive denominator)."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    whole = f"SIGN({n}) * ((2 * ABS({n}) * {10 ** places} + {d}) // (2 * {d}))"
    return f"CASE WHEN {d} <> 0 THEN {dbl(whole)} / {10 ** places} END"


def even(x: str, places: int = 0) -> str:
    return f"ROUND_EVEN({dbl(x)}, {places})"


def r6(x: str, places: int = 6) -> str:
    return f"ROUND({dbl(x)}, {places})"


def quintile(rank: str, n: str, reverse: bool = False) -> str:
    score = f"GREATEST(1, (5 * ({rank} - 1) + {n} - 2) // ({n} - 1))"
    return int_(f"6 - {score}" if reverse else score)


VIEWS = {
    "places": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "cust": """
        SELECT c_custkey AS customer_id, c_name AS name, lower(c_name) || '@example.com' AS email,
               CASE WHEN c_custkey % 25 = 0 THEN 'Other' WHEN c_custkey % 2 = 1 THEN 'Female' ELSE 'Male' END AS gender,
               CAST((c_custkey * 37) % 110 AS INTEGER) AS age, n_name AS city, n_name AS state, r_name AS region,
               DATE '1995-01-01' + CAST((c_custkey * 13) % 2400 AS INTEGER) AS signup_date,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Gold' WHEN 'BUILDING' THEN 'Silver'
                    WHEN 'FURNITURE' THEN 'Bronze' WHEN 'HOUSEHOLD' THEN 'Platinum' ELSE 'Unknown' END AS loyalty_tier,
               CAST(FLOOR(c_acctbal) AS INTEGER) AS loyalty_points
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "prod": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_name AS subcategory, p_brand AS brand,
               CASE WHEN p_partkey % 50 = 0 THEN CAST(-1 AS DECIMAL(10,2))
                    ELSE CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.45 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2))
               END AS unit_cost,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
        FROM part""",
    "hdr": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderpriority AS payment_method,
               CASE WHEN o_orderstatus = 'F' THEN 'In-Store' ELSE 'Online' END AS channel
        FROM orders""",
    "ord": """
        SELECT hdr.*, r_name AS store_region FROM hdr
        LEFT JOIN customer ON customer_id = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey""",
    "itm0": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
               CAST(CAST(l_discount AS DECIMAL(5,4)) * 3 AS DECIMAL(5,4)) AS discount
        FROM lineitem""",
    "itm": """
        SELECT *, CAST(ROUND(unit_price * quantity * (1 - discount), 2) AS DECIMAL(12,2)) AS line_total FROM itm0""",
    "sales": """
        SELECT order_id, customer_id, product_id, order_date AS date_key, quantity, unit_price, discount, line_total,
               payment_method, channel, store_region
        FROM itm JOIN ord USING (order_id)""",
    "days": f"""
        SELECT CAST(UNNEST(GENERATE_SERIES(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS date_key FROM hdr""",
    "cal": """
        SELECT date_key, CAST(YEAR(date_key) AS INTEGER) AS year, CAST(QUARTER(date_key) AS INTEGER) AS quarter,
               CAST(MONTH(date_key) AS INTEGER) AS month, MONTHNAME(date_key) AS month_name,
               CAST(DAY(date_key) AS INTEGER) AS day, CAST(ISODOW(date_key) - 1 AS INTEGER) AS day_of_week,
               DAYNAME(date_key) AS day_name, CAST(CASE WHEN ISODOW(date_key) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
        FROM days""",
    "stats": f"""
        SELECT customer_id, COUNT(*) AS frequency, SUM(total_amount) AS monetary, MAX(order_date) AS last_day,
               MIN(order_date) AS first_day,
               SUM(CASE WHEN order_date > {CUT} - 90 THEN total_amount ELSE 0 END) AS recent,
               SUM(CASE WHEN order_date > {CUT} - 180 AND order_date <= {CUT} - 90 THEN total_amount ELSE 0 END) AS prior
        FROM hdr WHERE order_date <= {CUT} GROUP BY customer_id""",
    "rfm": f"""
        SELECT c.customer_id, GREATEST(CAST({CUT} - COALESCE(last_day, signup_date) AS INTEGER), 0) AS recency_days,
               COALESCE(frequency, 0) AS frequency, COALESCE(monetary, 0) AS monetary,
               CASE WHEN frequency > 0 THEN CAST(monetary AS DOUBLE) / frequency ELSE 0.0::DOUBLE END AS avg_order_value
        FROM cust c LEFT JOIN stats USING (customer_id)""",
    "ranks": """
        SELECT *, ROW_NUMBER() OVER (ORDER BY recency_days, customer_id) AS rr,
               ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS fr,
               ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS mr, COUNT(*) OVER () AS n
        FROM rfm""",
    "scores": f"""
        SELECT customer_id, recency_days, frequency, monetary, avg_order_value,
               {quintile('rr', 'n', True)} AS r_s, {quintile('fr', 'n')} AS f_s, {quintile('mr', 'n')} AS m_s
        FROM ranks""",
    "lines": f"""
        SELECT i.*, o.customer_id, p.category FROM itm i JOIN hdr o USING (order_id) LEFT JOIN prod p USING (product_id)
        WHERE o.order_date <= {CUT}""",
    "basket": """
        SELECT customer_id, SUM(quantity) AS units, COUNT(DISTINCT product_id) AS products,
               COUNT(DISTINCT category) AS categories, CAST(SUM(discount) AS DOUBLE) / COUNT(discount) AS avg_discount
        FROM lines GROUP BY customer_id""",
    "feat": f"""
        SELECT c.customer_id, c.loyalty_tier, c.loyalty_points, c.region, c.age, c.gender,
               GREATEST(CAST({CUT} - c.signup_date AS INTEGER), 0) AS customer_tenure_days, r.recency_days,
               r.frequency, CAST(r.monetary AS DOUBLE) AS monetary, r.avg_order_value,
               CAST(COALESCE(b.units, 0) AS BIGINT) AS total_items_purchased,
               COALESCE(b.products, 0) AS unique_products_purchased, COALESCE(b.categories, 0) AS unique_categories_purchased,
               COALESCE(b.avg_discount, 0.0::DOUBLE) AS average_discount,
               CASE WHEN s.prior > 0 THEN CAST(s.recent AS DOUBLE) / CAST(s.prior AS DOUBLE)
                    WHEN s.recent > 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS purchase_trend_ratio,
               CAST(CASE c.loyalty_tier WHEN 'Silver' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Platinum' THEN 3 ELSE 0 END AS INTEGER)
                   AS loyalty_tier_encoded
        FROM cust c JOIN rfm r USING (customer_id) LEFT JOIN stats s USING (customer_id) LEFT JOIN basket b USING (customer_id)""",
    "churnlab": f"""
        SELECT c.customer_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM hdr h WHERE h.customer_id = c.customer_id
               AND h.order_date > {CUT} AND h.order_date <= {END}) THEN 0 ELSE 1 END AS INTEGER) AS churned
        FROM cust c WHERE c.signup_date <= {CUT}""",
    "churnset": "SELECT feat.*, churned FROM feat JOIN churnlab USING (customer_id)",
    "preds": """
        SELECT l.customer_id, l.churned AS actual_churned, CAST(LEAST(recency_days, 500) >= 250 AS INTEGER) AS predicted_churned,
               CAST(LEAST(recency_days, 500) AS DOUBLE) / 500 AS churn_probability,
               CAST(LEAST(recency_days, 500) * 20 AS BIGINT) AS p10k
        FROM churnlab l JOIN rfm USING (customer_id)""",
    "segs": """
        SELECT customer_id, recency_days, frequency, monetary, cluster,
               CASE cluster WHEN 0 THEN 'Champions' WHEN 1 THEN 'Loyal Customers' WHEN 2 THEN 'New Customers'
                    WHEN 3 THEN 'At Risk' ELSE 'Hibernating' END AS segment
        FROM (SELECT *, CAST(CASE WHEN recency_days <= 60 AND frequency >= 12 THEN 0
                     WHEN recency_days <= 180 AND frequency >= 8 THEN 1 WHEN recency_days <= 120 THEN 2
                     WHEN monetary >= 2500000 THEN 3 ELSE 4 END AS INTEGER) AS cluster FROM rfm)""",
    "mixed": """
        SELECT *, md5(CAST(customer_id AS VARCHAR) || ':42') AS mix FROM churnset""",
    "dealt": """
        SELECT *, ROW_NUMBER() OVER (ORDER BY churned, mix, customer_id) AS place,
               ROW_NUMBER() OVER (PARTITION BY churned ORDER BY mix, customer_id) AS turn FROM mixed""",
    "quota0": """
        SELECT churned, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM mixed GROUP BY churned""",
    "quota1": """
        SELECT churned, n, total, total - ((total * 2 + 9) // 10) AS want FROM quota0""",
    "quota2": """
        SELECT churned, n, want, (n * want) // total AS base, (n * want) % total AS rest FROM quota1""",
    "quota": """
        SELECT churned, base + CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, churned) <= want - SUM(base) OVER ()
               THEN 1 ELSE 0 END AS train FROM quota2""",
    "split": """
        SELECT d.*, d.turn > q.train AS is_test FROM dealt d JOIN quota q USING (churned)""",
    # --- tables with defects, and their cleaning ---
    "dcust0": """
        SELECT *, CAST(0 AS INTEGER) AS arrival FROM cust
        UNION ALL SELECT * REPLACE (name || ' (copy)' AS name), CAST(1 AS INTEGER) FROM cust WHERE customer_id % 17 = 0""",
    "dcust": """
        SELECT CASE WHEN customer_id % 101 <> 0 THEN customer_id END AS customer_id,
               CASE WHEN customer_id % 41 <> 0 THEN name END AS name, CASE WHEN customer_id % 19 <> 0 THEN email END AS email,
               CASE WHEN customer_id % 43 <> 0 THEN gender END AS gender, CASE WHEN customer_id % 37 <> 0 THEN age END AS age,
               CASE WHEN customer_id % 23 <> 0 THEN city END AS city, CASE WHEN customer_id % 47 <> 0 THEN state END AS state,
               CASE WHEN customer_id % 53 <> 0 THEN region END AS region,
               CASE WHEN customer_id % 31 = 0 THEN 'not a date' ELSE CAST(signup_date AS VARCHAR) END AS signup_date,
               CASE WHEN customer_id % 29 <> 0 THEN loyalty_tier END AS loyalty_tier,
               CASE WHEN customer_id % 59 <> 0 THEN loyalty_points END AS loyalty_points, arrival
        FROM dcust0""",
    "cust1": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY arrival) AS rn FROM dcust) WHERE rn = 1""",
    "cust2": "SELECT * FROM cust1 WHERE customer_id IS NOT NULL",
    "agemed": "SELECT QUANTILE_CONT(CAST(age AS DOUBLE), 0.5) AS med FROM cust2 WHERE age BETWEEN 16 AND 100",
    "ccust": """
        SELECT customer_id, COALESCE(name, 'Unknown') AS name, COALESCE(email, 'Unknown') AS email, gender,
               CASE WHEN age BETWEEN 16 AND 100 THEN age ELSE (SELECT CAST(TRUNC(med) AS INTEGER) FROM agemed) END AS age,
               COALESCE(city, 'Unknown') AS city, COALESCE(state, 'Unknown') AS state, COALESCE(region, 'Unknown') AS region,
               TRY_CAST(signup_date AS DATE) AS signup_date,
               CASE WHEN loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum') THEN loyalty_tier ELSE 'Bronze' END AS loyalty_tier,
               CASE WHEN loyalty_points < 0 THEN 0 ELSE loyalty_points END AS loyalty_points
        FROM cust2 WHERE TRY_CAST(signup_date AS DATE) IS NOT NULL""",
    "dprod0": """
        SELECT *, CAST(0 AS INTEGER) AS arrival FROM prod
        UNION ALL SELECT * REPLACE (product_name || ' (copy)' AS product_name), CAST(1 AS INTEGER) FROM prod WHERE product_id % 13 = 0""",
    "dprod": """
        SELECT CASE WHEN product_id % 97 <> 0 THEN product_id END AS product_id, product_name, category, subcategory, brand,
               CASE WHEN product_id % 43 = 0 THEN CAST(unit_price + 1 AS DECIMAL(10,2)) WHEN product_id % 47 <> 0 THEN unit_cost END AS unit_cost,
               CASE WHEN product_id % 29 = 0 THEN NULL WHEN product_id % 31 = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE unit_price END AS unit_price, arrival
        FROM dprod0""",
    "prod1": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY arrival) AS rn FROM dprod) WHERE rn = 1""",
    "prod2": "SELECT * FROM prod1 WHERE product_id IS NOT NULL",
    "pricemed": "SELECT QUANTILE_CONT(CAST(unit_price AS DOUBLE), 0.5) AS med FROM prod2 WHERE unit_price > 0",
    "prod3": """
        SELECT * REPLACE (CASE WHEN unit_price > 0 THEN unit_price
               ELSE (SELECT CAST(ROUND(med, 2) AS DECIMAL(10,2)) FROM pricemed) END AS unit_price) FROM prod2""",
    "cprod": """
        SELECT product_id, product_name, category, subcategory, brand,
               CASE WHEN unit_cost > 0 AND unit_cost < unit_price THEN unit_cost
                    ELSE CAST(ROUND(unit_price * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) END AS unit_cost, unit_price
        FROM prod3""",
    "dord0": """
        SELECT *, CAST(0 AS INTEGER) AS arrival FROM ord
        UNION ALL SELECT * REPLACE (payment_method || ' (copy)' AS payment_method), CAST(1 AS INTEGER) FROM ord WHERE order_id % 19 = 0""",
    "dord": """
        SELECT order_id, CASE WHEN order_id % 53 = 0 THEN -customer_id - 1 WHEN order_id % 59 <> 0 THEN customer_id END AS customer_id,
               CASE WHEN order_id % 61 = 0 THEN '2001-02-30' ELSE CAST(order_date AS VARCHAR) END AS order_date,
               CASE WHEN order_id % 67 = 0 THEN CAST(-total_amount AS DECIMAL(12,2)) WHEN order_id % 71 <> 0 THEN total_amount END AS total_amount,
               payment_method, channel, store_region, arrival
        FROM dord0""",
    "ord1": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY arrival) AS rn FROM dord) WHERE rn = 1""",
    "ord2": "SELECT * FROM ord1 WHERE customer_id IN (SELECT customer_id FROM ccust)",
    "ord3": "SELECT * FROM ord2 WHERE TRY_CAST(order_date AS DATE) IS NOT NULL",
    "ord4": "SELECT * FROM ord3 WHERE total_amount >= 0",
    "ditm": """
        SELECT CASE WHEN h % 73 = 0 THEN -order_id - 1 ELSE order_id END AS order_id,
               CASE WHEN h % 79 = 0 THEN -1 ELSE product_id END AS product_id,
               CASE WHEN h % 83 = 0 THEN 0 WHEN h % 89 <> 0 THEN quantity END AS quantity, unit_price,
               CASE WHEN h % 103 = 0 THEN CAST(-0.1 AS DECIMAL(5,4)) WHEN h % 107 = 0 THEN CAST(1.5 AS DECIMAL(5,4))
                    WHEN h % 109 <> 0 THEN discount END AS discount,
               CASE WHEN h % 97 = 0 THEN CAST(-line_total AS DECIMAL(12,2)) WHEN h % 101 <> 0 THEN line_total END AS line_total
        FROM (SELECT *, order_id * 7 + product_id AS h FROM itm)""",
    "itm1": "SELECT * FROM ditm WHERE order_id IN (SELECT order_id FROM ord4)",
    "itm2": "SELECT * FROM itm1 WHERE product_id IN (SELECT product_id FROM cprod)",
    "itm3": "SELECT * FROM itm2 WHERE quantity > 0",
    "itm4": "SELECT * FROM itm3 WHERE line_total >= 0",
    "citm": """
        SELECT order_id, product_id, quantity, unit_price,
               CASE WHEN discount < 0 THEN CAST(0 AS DECIMAL(5,4)) WHEN discount > 0.9 THEN CAST(0.9 AS DECIMAL(5,4)) ELSE discount END AS discount,
               line_total FROM itm4""",
    "sums": "SELECT order_id, SUM(line_total) AS lines_total FROM citm GROUP BY order_id",
    "ord5": "SELECT o.*, s.lines_total FROM ord4 o LEFT JOIN sums s USING (order_id)",
    "cord": """
        SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date,
               CAST(CASE WHEN ABS(total_amount - lines_total) > 1 THEN lines_total ELSE total_amount END AS DECIMAL(12,2)) AS total_amount,
               payment_method, channel, store_region
        FROM ord5 WHERE lines_total IS NOT NULL""",
}


def _check(seq: int, dataset: str, check: str, count: str, action: str) -> str:
    return (
        f"SELECT CAST({seq} AS INTEGER) AS seq, '{dataset}' AS dataset, '{check}' AS \"check\", "
        f"CAST(({count}) AS BIGINT) AS issue_count, {action} AS action_taken"
    )


def _minus(a: str, b: str) -> str:
    return f"(SELECT COUNT(*) FROM {a}) - (SELECT COUNT(*) FROM {b})"


def _where(view: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {view} WHERE {condition}"


def quality_report() -> str:
    rows = [
        _check(1, "customers", "duplicate_customer_id", _minus("dcust", "cust1"), "'dropped duplicates, kept first occurrence'"),
        _check(2, "customers", "missing_customer_id", _minus("cust1", "cust2"), "'dropped rows with missing customer_id'"),
    ]
    for i, c in enumerate(["name", "email", "city", "state", "region", "loyalty_tier"]):
        count = _where("cust2", f"{c} IS NULL")
        rows.append(_check(3 + i, "customers", f"missing_{c}", count, f"CASE WHEN ({count}) > 0 THEN 'filled with ''Unknown''' ELSE 'none found' END"))
    rows += [
        _check(9, "customers", "invalid_age", _where("cust2", "age IS NULL OR age NOT BETWEEN 16 AND 100"),
               "'replaced with median age (' || (SELECT CAST(ROUND_EVEN(med, 0) AS INTEGER) FROM agemed) || ')'"),
        _check(10, "customers", "negative_loyalty_points", _where("cust2", "loyalty_points < 0"), "'clipped to 0'"),
        _check(11, "customers", "invalid_signup_date", _where("cust2", "TRY_CAST(signup_date AS DATE) IS NULL"), "'dropped rows with unparseable signup_date'"),
        _check(12, "customers", "invalid_loyalty_tier", _where("cust2", "TRY_CAST(signup_date AS DATE) IS NOT NULL AND COALESCE(loyalty_tier, 'Unknown') NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')"), "'defaulted to ''Bronze'''"),
        _check(13, "products", "duplicate_product_id", _minus("dprod", "prod1"), "'dropped duplicates, kept first occurrence'"),
        _check(14, "products", "missing_product_id", _minus("prod1", "prod2"), "'dropped rows with missing product_id'"),
        _check(15, "products", "invalid_unit_price", _where("prod2", "unit_price IS NULL OR unit_price <= 0"),
               "'replaced with median price (' || (SELECT printf('%.2f', med) FROM pricemed) || ')'"),
        _check(16, "products", "invalid_unit_cost", _where("prod3", "unit_cost IS NULL OR unit_cost <= 0 OR unit_cost >= unit_price"), "'recomputed as 60% of unit_price'"),
        _check(17, "orders", "duplicate_order_id", _minus("dord", "ord1"), "'dropped duplicates, kept first occurrence'"),
        _check(18, "orders", "orphan_customer_reference", _minus("ord1", "ord2"), "'dropped orders referencing unknown customers'"),
        _check(19, "orders", "invalid_order_date", _minus("ord2", "ord3"), "'dropped rows with unparseable order_date'"),
        _check(20, "orders", "negative_total_amount", _where("ord3", "total_amount < 0"), "'dropped rows with negative total_amount'"),
        _check(21, "order_items", "orphan_order_reference", _minus("ditm", "itm1"), "'dropped items referencing unknown/removed orders'"),
        _check(22, "order_items", "orphan_product_reference", _minus("itm1", "itm2"), "'dropped items referencing unknown products'"),
        _check(23, "order_items", "invalid_quantity", _minus("itm2", "itm3"), "'dropped rows with non-positive quantity'"),
        _check(24, "order_items", "invalid_line_total", _minus("itm3", "itm4"), "'dropped rows with negative/missing line_total'"),
        _check(25, "order_items", "invalid_discount_range", _where("itm4", "discount < 0 OR discount > 0.9"), "'clipped discount to [0, 0.9]'"),
        _check(26, "orders", "total_amount_mismatch_vs_line_items", _where("ord5", "ABS(total_amount - COALESCE(lines_total, 0)) > 1"), "'recalculated total_amount from order_items line totals'"),
        _check(27, "orders", "orders_with_no_valid_items", _where("ord5", "lines_total IS NULL"), "'dropped orders with zero remaining valid line items'"),
    ]
    return " UNION ALL ".join(rows)


VIEWS["quality"] = quality_report()


def with_views(body: str) -> str:
    """Put the views a query uses, and those they use, in front of it."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in VIEWS and word not in seen:
                seen.add(word)
                visit(VIEWS[word])
                needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + body

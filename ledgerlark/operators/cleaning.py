"""Rule-based cleaning with a quality report.

Each table goes through its rules in a fixed order and every rule counts only rows that the
rules before it left. The rules become boolean columns of one plan: `_gone` names the first
rule that drops a row, and one aggregate per table counts all rules at once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.encode import member
from ledgerlark.functions.numeric import clip
from ledgerlark.functions.text import parse_date
from ledgerlark.operators.ranking import exact_median, keep_first
from ledgerlark.session import stage

# Text columns that must not be null, the known tiers, and the valid ranges.
FILLED_COLUMNS = ["name", "email", "city", "state", "region", "loyalty_tier"]
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
AGE_RANGE = (16, 100)
DISCOUNT_RANGE = (0.0, 0.9)
COST_SHARE = "0.6"
TOTAL_TOLERANCE = 1.0

# The checks of the report in the order of the log, with the action each takes.
# A %s stands for the median used.
REPORT = [
    ("customers", "duplicate_customer_id", "dropped duplicates, kept first occurrence"),
    ("customers", "missing_customer_id", "dropped rows with missing customer_id"),
    ("customers", "missing_name", "filled with 'Unknown'"),
    ("customers", "missing_email", "filled with 'Unknown'"),
    ("customers", "missing_city", "filled with 'Unknown'"),
    ("customers", "missing_state", "filled with 'Unknown'"),
    ("customers", "missing_region", "filled with 'Unknown'"),
    ("customers", "missing_loyalty_tier", "filled with 'Unknown'"),
    ("customers", "invalid_age", "replaced with median age (%s)"),
    ("customers", "negative_loyalty_points", "clipped to 0"),
    ("customers", "invalid_signup_date", "dropped rows with unparseable signup_date"),
    ("customers", "invalid_loyalty_tier", "defaulted to 'Bronze'"),
    ("products", "duplicate_product_id", "dropped duplicates, kept first occurrence"),
    ("products", "missing_product_id", "dropped rows with missing product_id"),
    ("products", "invalid_unit_price", "replaced with median price (%s)"),
    ("products", "invalid_unit_cost", "recomputed as 60% of unit_price"),
    ("orders", "duplicate_order_id", "dropped duplicates, kept first occurrence"),
    ("orders", "orphan_customer_reference", "dropped orders referencing unknown customers"),
    ("orders", "invalid_order_date", "dropped rows with unparseable order_date"),
    ("orders", "negative_total_amount", "dropped rows with negative total_amount"),
    ("order_items", "orphan_order_reference", "dropped items referencing unknown/removed orders"),
    ("order_items", "orphan_product_reference", "dropped items referencing unknown products"),
    ("order_items", "invalid_quantity", "dropped rows with non-positive quantity"),
    ("order_items", "invalid_line_total", "dropped rows with negative/missing line_total"),
    ("order_items", "invalid_discount_range", "clipped discount to [0, 0.9]"),
    ("orders", "total_amount_mismatch_vs_line_items", "recalculated total_amount from order_items line totals"),
    ("orders", "orders_with_no_valid_items", "dropped orders with zero remaining valid line items"),
]
NOTHING_FILLED = "none found"


@dataclass
class Cleaned:
    """Cleaned rows and the report rows (seq, dataset, check, issue_count, action_taken)."""

    rows: DataFrame
    report: DataFrame


def _report(counts: DataFrame, found: dict[str, str], median: Column | None = None) -> DataFrame:
    """Turn one row of counts into report rows; `found` maps checks to columns of the row."""
    rows = []
    for seq, (dataset, check, action) in enumerate(REPORT, start=1):
        if check not in found:
            continue
        count = F.coalesce(found[check], F.lit(0)).cast("long")
        text = F.lit(action)
        if "%s" in action:
            before, after = action.split("%s")
            text = F.concat(F.lit(before), F.coalesce(median, F.lit("nan")), F.lit(after))
        elif check.removeprefix("missing_") in FILLED_COLUMNS:
            text = F.when(count > 0, text).otherwise(NOTHING_FILLED)
        rows.append(F.struct(
            F.lit(seq).alias("seq"), F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
            count.alias("issue_count"), text.alias("action_taken"),
        ))
    return counts.select(F.inline(F.array(*rows)))


def _first_rule(*rules: tuple[str, Column]) -> Column:
    found = F
    for name, broken in rules:
        found = found.when(broken, F.lit(name))
    return found


def _is(name: str) -> Column:
    return F.col("_gone") == name


def _dropped(name: str) -> Column:
    return F.count_if(_is(name)).alias(name)


def _deduplicated(df: DataFrame, key: str, arrival: list[str] | None) -> tuple[DataFrame, list[str]]:
    """First row per key with the group size in `_copies`; arrival columns are dropped after.

    Staged, since the cleaned rows, the report and the medians all read it.
    """
    order = arrival or []
    first = stage(keep_first(df, key, order, copies="_copies"), "first")
    if not order:
        _refuse_copies(first, key)
    return first, [c for c in df.columns if c not in order]


def _refuse_copies(first: DataFrame, key: str) -> None:
    """Without an order of arrival "the first occurrence" has no meaning for a key with copies."""
    if not first.where((F.col("_copies") > 1) & F.col(key).isNotNull()).isEmpty():
        raise ValueError(f"{key} has copies: name the columns that say which of them arrived first")


def clean_customers(df: DataFrame, arrival: list[str] | None = None) -> Cleaned:
    """Customers with unique non-null ids, valid dates and repaired values.

    `arrival` lists the columns that say which of several copies came first; it may be left out
    only where no id has copies.
    """
    first, columns = _deduplicated(df, "customer_id", arrival)
    age = F.col("age")
    points = F.col("loyalty_points")
    # The domain of valid ages is fixed (85 values), so the built-in median stays small.
    known = first.where(F.col("customer_id").isNotNull())
    median_age = known.where(age.between(*AGE_RANGE)).agg(F.median("age").alias("m")).scalar()
    bad_age = ~F.coalesce(age.between(*AGE_RANGE), F.lit(False))
    signup = parse_date(F.col("signup_date").cast("string"))
    tier = F.coalesce("loyalty_tier", F.lit("Unknown"))
    ruled = first.withColumns({
        "_gone": _first_rule(("id", F.col("customer_id").isNull()), ("date", signup.isNull())),
        "_bad_age": bad_age,
        "_bad_points": F.coalesce(points < 0, F.lit(False)),
        "_bad_tier": ~member(tier, TIERS),
        "_median": median_age,
    })
    kept_id = F.col("customer_id").isNotNull()
    counts = ruled.agg(
        F.sum(F.col("_copies") - 1).alias("dup"),
        _dropped("id"),
        *[F.count_if(kept_id & F.col(c).isNull()).alias(f"no_{c}") for c in FILLED_COLUMNS],
        F.count_if(kept_id & F.col("_bad_age")).alias("age"),
        F.max("_median").alias("median"),
        F.count_if(kept_id & F.col("_bad_points")).alias("points"),
        _dropped("date"),
        F.count_if(F.col("_gone").isNull() & F.col("_bad_tier")).alias("tier"),
    )
    checks = {
        "duplicate_customer_id": "dup", "missing_customer_id": "id", "invalid_age": "age", "negative_loyalty_points": "points",
        "invalid_signup_date": "date", "invalid_loyalty_tier": "tier", **{f"missing_{c}": f"no_{c}" for c in FILLED_COLUMNS},
    }
    report = _report(counts, checks, F.bround("median").cast("int").cast("string"))
    repairs = {c: F.coalesce(c, F.lit("Unknown")) for c in FILLED_COLUMNS if c != "loyalty_tier"}
    repairs |= {
        "loyalty_tier": F.when(F.col("_bad_tier"), "Bronze").otherwise(tier),
        "age": F.when(F.col("_bad_age"), F.col("_median").cast("int")).otherwise(age.cast("int")),
        "loyalty_points": F.when(F.col("_bad_points"), F.lit(0)).otherwise(points),
        "signup_date": signup,
    }
    rows = ruled.where(F.col("_gone").isNull()).withColumns(repairs).select(*columns)
    return Cleaned(rows, report)


def clean_products(df: DataFrame, arrival: list[str] | None = None) -> Cleaned:
    """Products with unique ids, positive prices, and costs below the repaired price."""
    first, columns = _deduplicated(df, "product_id", arrival)
    price, cost = F.col("unit_price"), F.col("unit_cost")
    known = first.where(F.col("product_id").isNotNull())
    median_price = exact_median(known.where(price > 0), "unit_price").scalar()
    fixed_price = F.when(F.coalesce(price > 0, F.lit(False)), price).otherwise(
        F.col("_median").cast(df.schema["unit_price"].dataType)
    )
    ruled = first.withColumn("_median", median_price).withColumns({
        "_bad_price": ~F.coalesce(price > 0, F.lit(False)),
        "_price": fixed_price,
    }).withColumn("_bad_cost", ~F.coalesce((cost > 0) & (cost < F.col("_price")), F.lit(False)))
    kept = F.col("product_id").isNotNull()
    counts = ruled.agg(
        F.sum(F.col("_copies") - 1).alias("dup"),
        F.count_if(~kept).alias("id"),
        F.count_if(kept & F.col("_bad_price")).alias("price"),
        F.count_if(kept & F.col("_bad_cost")).alias("cost"),
        F.max("_median").alias("median"),
    )
    checks = {
        "duplicate_product_id": "dup", "missing_product_id": "id", "invalid_unit_price": "price", "invalid_unit_cost": "cost",
    }
    report = _report(counts, checks, F.format_string("%.2f", "median"))
    fixed_cost = (F.col("_price") * F.lit(COST_SHARE).cast("decimal(2,1)")).cast(df.schema["unit_cost"].dataType)
    rows = ruled.where(kept).withColumns({
        "unit_price": F.col("_price"),
        "unit_cost": F.when(F.col("_bad_cost"), fixed_cost).otherwise(cost),
    }).select(*columns)
    return Cleaned(rows, report)


def clean_orders_and_items(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    arrival: list[str] | None = None,
) -> tuple[Cleaned, Cleaned]:
    """Orders and lines that refer to known rows, with header totals that match their lines.

    The ids of valid customers and products are joined, never collected. Orders and lines that
    pass their own rules are staged once, since the later rules and both results read them.
    """
    order = arrival or []
    first = keep_first(orders, "order_id", order, copies="_copies")
    columns = [c for c in orders.columns if c not in order]
    known = customers.select(F.col("customer_id")).distinct().withColumn("_known", F.lit(True))
    parsed = parse_date(F.col("order_date").cast("string"))
    total = F.col("total_amount")
    ruled = stage(
        first.join(known, "customer_id", "left")
        .withColumn("_date", parsed)
        .withColumn("_gone", _first_rule(
            ("customer", F.col("_known").isNull()),
            ("date", F.col("_date").isNull()),
            ("total", F.coalesce(total < 0, F.lit(False))),
            ("no_total", total.isNull()),
        ))
        .withColumn("order_date", F.col("_date")).drop("_date", "_known"),
        "orders",
    )
    if not order:
        _refuse_copies(ruled, "order_id")
    order_counts = ruled.agg(
        F.sum(F.col("_copies") - 1).alias("dup"), _dropped("customer"), _dropped("date"), _dropped("total")
    )
    valid = ruled.where(F.col("_gone").isNull()).select(*columns)

    sold = products.select("product_id").distinct().withColumn("_sold", F.lit(True))
    of_order = valid.select("order_id").withColumn("_ordered", F.lit(True))
    low, high = (F.lit(str(v)).cast("decimal(5,4)") for v in DISCOUNT_RANGE)
    discount = F.col("discount")
    item_columns = [c for c in items.columns]
    lines = stage(
        items.join(of_order, "order_id", "left").join(sold, "product_id", "left")
        .withColumn("_gone", _first_rule(
            ("order", F.col("_ordered").isNull()),
            ("product", F.col("_sold").isNull()),
            ("quantity", ~F.coalesce(F.col("quantity") > 0, F.lit(False))),
            ("line", ~F.coalesce(F.col("line_total") >= 0, F.lit(False))),
        ))
        .withColumn("_bad_discount", F.coalesce((discount < low) | (discount > high), F.lit(False)))
        .withColumn("discount", clip(discount, low, high).cast(items.schema["discount"].dataType))
        .select(*item_columns, "_gone", "_bad_discount"),
        "items",
    )
    item_counts = lines.agg(
        _dropped("order"), _dropped("product"), _dropped("quantity"), _dropped("line"),
        F.count_if(F.col("_gone").isNull() & F.col("_bad_discount")).alias("discount"),
    )
    clean_lines = lines.where(F.col("_gone").isNull()).select(*item_columns)

    sums = clean_lines.groupBy("order_id").agg(F.round(F.sum("line_total"), 2).alias("_lines"))
    # `_lines` is never null for an order that has lines: null line totals are dropped above.
    matched = valid.join(sums, "order_id", "left").withColumn(
        "_off", F.abs(total - F.coalesce("_lines", F.lit(0))) > F.lit(TOTAL_TOLERANCE)
    )
    matched_counts = matched.agg(
        F.count_if("_off").alias("off"), F.count_if(F.col("_lines").isNull()).alias("empty")
    )
    fixed_total = F.when(F.col("_off"), F.col("_lines").cast(orders.schema["total_amount"].dataType)).otherwise(total)
    clean_orders = (
        matched.where(F.col("_lines").isNotNull()).withColumn("total_amount", fixed_total).select(*columns)
    )

    order_report = _report(order_counts, {
        "duplicate_order_id": "dup", "orphan_customer_reference": "customer", "invalid_order_date": "date",
        "negative_total_amount": "total",
    }).unionByName(_report(matched_counts, {
        "total_amount_mismatch_vs_line_items": "off", "orders_with_no_valid_items": "empty",
    }))
    item_report = _report(item_counts, {
        "orphan_order_reference": "order", "orphan_product_reference": "product", "invalid_quantity": "quantity",
        "invalid_line_total": "line", "invalid_discount_range": "discount",
    })
    return Cleaned(clean_orders, order_report), Cleaned(clean_lines, item_report)


@dataclass
class CleanTables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    report: DataFrame


def clean_tables(
    customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, arrival: list[str] | None = None
) -> CleanTables:
    """Clean all four tables and join their reports to the one of 27 checks."""
    c = clean_customers(customers, arrival)
    p = clean_products(products, arrival)
    o, i = clean_orders_and_items(orders, items, c.rows, p.rows, arrival)
    report = reduce(DataFrame.unionByName, [c.report, p.report, o.report, i.report])
    return CleanTables(c.rows, p.rows, o.rows, i.rows, report.orderBy("seq"))


def total_issues(report: DataFrame) -> DataFrame:
    return report.agg(F.sum("issue_count").alias("total_issues"))

"""Headline queries on one folder of given tables; prints one JSON line.

Each query is planned from fresh views and written to the `noop` sink, so every row and column
is computed and nothing is shared between queries.
"""

from __future__ import annotations

import json
import os
import time

from checks.catalog import ENTRIES, all_queries
from checks.tables import CheckTables
from ledgerlark.session import build_session, drop_staged

HEADLINE = [
    "d01_total_revenue", "d02_monthly_revenue", "d03_mom_growth", "d04_top_products", "d05_bottom_products",
    "d06_category_performance", "d07_regional_performance", "d08_lifetime_value", "d09_repeat_rate",
    "d10_order_value_by_channel", "d11_tier_performance", "d12_inactivity", "d13_cumulative_revenue",
    "d14_top_customers_per_region", "d15_order_frequency", "d16_payment_methods", "d17_discount_impact",
    "d18_date_dimension", "d19_sales_fact", "c23_quality_report", "l05_rfm_text", "l10_customer_features",
    "l12_churn_dataset", "m02_stratified_split", "m09_roc_auc", "g04_silhouette", "b08_sales_extract",
    "b09_customer_extract", "k12_slicer_cube", "s06_upsert",
]
#: Dearer queries, timed too but reported apart from the headline total.
APART = ["c00_clean_items", "g04_euclidean_silhouette", "x15_daily_events", "d20_constraint_audit", "b06_headline", "b14_report_bundle", "k12_all_slicers"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    all_queries()
    seconds = {}
    ENTRIES["d02_monthly_revenue"][0](CheckTables(spark, folder)).count()
    for name in [*HEADLINE, *APART]:
        start = time.perf_counter()
        ENTRIES[name][0](CheckTables(spark, folder)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_staged(spark)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    apart = {name: seconds.pop(name) for name in APART}
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "apart": apart, "sf": sf}))


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8),
BENCH_RUNS how often each query runs (the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwork.registry import QUERIES  # noqa: E402
from tillwork.session import build_session  # noqa: E402

HEADLINE = [
    "q1_monthly_growth", "q2_top_customers", "q3_brand_returns", "q4_cohort_retention",
    "q5_traffic_funnel", "q6_delivery_by_center", "q7_rfm_segments",
    "e11_monthly_revenue", "e14_price_profile", "e23_source_conversion", "e25_country_returns",
    "e52_category_margin", "e55_category_by_gender", "e63_delivery_by_country",
    "e64_delivery_correlation", "dq03_nulls", "dq05_key_duplicates", "dq07_ranges",
    "s1_order_anomaly", "s2_traffic_funnel", "s3_inventory_state", "s4_revenue_dashboard",
    "s4_revenue_dashboard_stream", "r5_key_figures", "p1_item_features", "p2_return_vectors", "p4_price_vectors",
    "m1_return_prediction", "m2_customer_clusters", "m3_price_prediction", "e54_double_risk",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dq01_table_shapes"](spark, folder).collect()  # start the JVM's engines
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()

"""Time the headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINES = (
    "top_state_product_window",
    "top_state_with_age",
    "purchases_by_state_in_age_band",
    "sales_raw_to_bronze",
    "sales_rejects",
    "sales_raw_to_silver",
    "customers_dumps_latest",
    "profiles_raw_to_silver",
    "enrich_left_fill",
    "gold_profiles_loaded",
    "latest_event_per_user",
    "one_event_per_type_and_user",
    "scaled_by_group",
    "average_by_two_keys",
    "median_by_two_keys",
    "distinct_count_by_key",
    "sum_by_two_keys",
    "count_by_derived_year",
    "upsert_filling",
    "money_from_text",
    "food_derived_columns",
    "food_statistics_exported",
)
# Each query is timed so often after a warm-up, which also writes the stand-in files it reads.
RUNS = 3


def main() -> None:
    from lakestrata.queries import queries
    from lakestrata.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}

    def timed(name: str) -> float:
        began = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for name in sys.argv[1:] or HEADLINES:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

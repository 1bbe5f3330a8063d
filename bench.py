"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import catalog
from tidemark.session import session

HEADLINE = [
    "m2_latest_observation", "m3_price_history", "m4_benchmarks", "m5_state_fingerprints", "m6_observation_fingerprints", "m7_state_runs", "m8_observation_runs", "m9_volatility_features", "m10_vehicle_snapshot", "m11_deal_scores",
    "m12_block_rate", "m13_cooldown_cohorts", "m14_batch_outcomes", "m15_inventory_coverage", "m16_price_freshness", "m17_scrape_volume", "m18_vehicle_staleness", "m19_refresh_queue", "cs1_price_state", "cs4_relistings",
    "inc1_rescan", "inc2_affected_history", "inc3_entity_runs", "inc4_time_window", "se2_state_change", "se5_price_drop", "se22_stale", "co4_closure", "q16_price_percentiles", "q18_block_rate", "q30_gauges", "dq6_row_parity", "du1_semantic_duplicates", "du4_exact_duplicates",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = session(f"local[{cpus}]", spark__driver__memory="8g", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("m11_deal_scores", "m17_scrape_volume"):  # compiles code and opens files
        catalog.QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

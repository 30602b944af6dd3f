"""Benchmark the headline plans.

Runs each plan at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8): one warm-up, then the median of three timed runs.
A run executes the whole plan through the no-op sink (nothing is collected to
the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# upsert_orders and synth_rows do other work than they did in round 1 and aren't part of the total: the first writes no table any
# more, the second also reads its JSON again; synth_json is what synth_rows was.
HEADLINE = ["tumble_sum_batch", "burst_calendar", "validate_report_lineitem", "relationalize_orders",
            "decode_json_topic", "synth_json"]
EXTRA = ["upsert_orders", "synth_rows", "user_bursts_day", "relationalize_items", "validate_unique", "validate_quarantine",
         "choice_types", "object_choice_types", "decode_wire_json", "decode_versions", "tumble_sum_stream", "nested_again",
         "synth_patterns"]


def run_once(spark, build, sf):
    t0 = time.perf_counter()
    build(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from tidewater.plans import PLANS
    from tidewater.session import build_session

    spark = build_session(f"local[{cpus}]", max(2 * cpus, 8), app="tidewater-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    names = HEADLINE + EXTRA
    results = {}
    for name in names:
        build = PLANS[name].build
        try:
            run_once(spark, build, sf)  # warm-up
            times = [run_once(spark, build, sf) for _ in range(runs)]
        except Exception as e:  # noqa: BLE001 - report the failure, keep benchmarking
            results[name] = None
            print(f"{name}: FAILED {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            continue
        results[name] = round(statistics.median(times), 3)
        print(f"{name}: {results[name]}s {[round(t, 3) for t in times]}", file=sys.stderr)
    done = [n for n in HEADLINE if results.get(n) is not None]
    headline = round(sum(results[n] for n in done), 3) if len(done) == len(HEADLINE) else None
    print(json.dumps({"metric": "headline_total_median_sec", "value": headline, "unit": "sec",
                      "queries": results, "sf": os.path.basename(sf).replace("sf", ""),
                      "cpus": cpus,
                      "total_all_sec": round(sum(v for v in results.values() if v is not None), 3)}))


if __name__ == "__main__":
    main()

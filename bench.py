"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from barorail.checks import catalog
from barorail.session import local_session

HEADLINE = (
    "dp1_harmonize",
    "q1_type_means",
    "q2_axis_means",
    "q3_best_and_worst_five",
    "q4_monthly_trend",
    "q5_price_per_km",
    "q9_price_and_punctuality",
    "q10_consolidated",
    "q13_year_matrix",
    "q14_punctuality_histogram",
    "dp6_stations_all",
    "dp14_rail_trips_extended",
    "dp15_stop_sequence_map",
    "dp16_liaisons",
    "dp17_fares",
    "dp18_dev_sample",
    "fn1_normalize_names",
    "sx1_anova_statistic",
    "sx3_price_rank_correlation",
    "dq3_duplicates",
    "dq4_outliers",
    "dq8_profile_sources",
    "rt1_resolved_messages",
    "rt3_interpolate",
    "rt12_live_trains",
    "str10_request_rate",
    "str11_latency_p95",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    for name in names[:2]:  # warm the session up
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(sorted(runs)[len(runs) // 2], 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

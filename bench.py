"""Time the headline queries: ``python bench.py`` prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8). Every query is run to
completion over all its rows and columns (a no-op sink, nothing is collected), once to warm up and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "perf_count", "perf_one_customer", "perf_three_months", "perf_segment_join", "agg_monthly_distinct",
    "agg_monthly_customer", "win_dedupe_latest", "jn_fact_enrich", "jn_star", "agg_star_segment_category",
    "agg_star_discretionary", "agg_customer_summary", "ca_segments", "ca_profile", "vq_top_ltv", "agg_state_segment",
    "ca_campaign_roi", "ca_priority", "agg_quartiles", "jn_asof_scd", "scd_merge", "cdc_merge_history", "cdc_apply_fact",
    "dq_transaction_suite", "ob_quality", "ml_labels", "ml_features", "sem_join", "win_global_row_id", "shp_monthly_panel",
)


def main() -> None:
    from clientele.plans import QUERIES
    from clientele.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])
    times = {}
    for name in names:
        run(name)
        times[name] = round(run(name), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

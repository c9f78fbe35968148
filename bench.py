"""Time the headline queries; prints one line of JSON."""

import json
import os
import time

from tideframe.plans import batches, jobs, registry  # noqa: F401  (the others add their queries to the registry)
from tideframe.session import session

HEADLINE = [
    "top_orders_by_year", "top_customers_by_year", "daily_event_trend", "keyword_counts", "token_pair_combinations", "channel_timeline", "best_observation_dedup",
    "channel_quadrant", "daily_metrics_with_all", "rankings_having", "theme_classification", "growth_excluding_trending", "snapshot_gate", "viral_score", "similarity_topk",
    "prepare_videos", "theme_tag_daily", "minhash_classes", "stream_score_by_theme",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", **{"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first compiles
            began = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        times[name] = round(min(runs), 3)
    print(json.dumps({"metric": "seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

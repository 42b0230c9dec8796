"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from holdlens.plans.queries import QUERIES

HEADLINE = (
    "leaderboard", "leaderboard_volume", "panel_scores", "panel_scores_volume", "rank_deltas_multi", "score_streaks", "burst", "velocity", "sector_flow",
    "fund_overlap_volume", "hc_entry_trades", "trade_stats", "series_stats_long", "price_log", "keep_last_upsert", "leverage_grid",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["leaderboard"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

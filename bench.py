"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time

HEADLINE = ("win01_latest_two", "jn02_known_categories", "agg01_newest_nonempty", "jn01_watchlist_cascade", "jn09_as_of_pick",
            "jn11_grid_candidates", "jn13_track_feature_candidates", "agg16_proximity_summary", "cls01_classify", "cls07_match_state",
            "jn14_time_aligned", "spa05_point_in_polygon", "cls10_review_objects", "ras01_cfar", "ras02_profiles", "str02_route_states", "str10_compaction")


def main() -> None:
    from wakeline import build_session
    from wakeline.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("wakeline-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wakeline-bench-checkpoint-")})
    spark.sparkContext.setLogLevel("ERROR")
    # Staged outside the clock as one file for each core: the given tables are one split each.
    staged = tempfile.mkdtemp(prefix="wakeline-bench-")
    rows = {}
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        table = spark.read.parquet(path)
        table.repartition(int(cpus)).write.parquet(f"{staged}/{os.path.basename(path)}")
        rows[os.path.basename(path).removesuffix(".parquet")] = table.count()
    QUERIES["agg09_provider_ranges"](spark, staged).collect()
    cold, times = {}, {}
    for times_of in (cold, times):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, staged).write.format("noop").mode("overwrite").save()
            times_of[name] = round(time.perf_counter() - start, 3)
    rates = {n: round(rows["lineitem" if n == "jn14_time_aligned" else "events"] / s) for n, s in times.items()}
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "cold": cold,
                      "rows_per_sec": rates, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

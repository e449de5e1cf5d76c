"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

One warm-up and three timed runs per query, median seconds. The result is written to the no-op sink,
so nothing is collected.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom.catalog import QUERIES, load_all  # noqa: E402
from wattloom.session import build_session  # noqa: E402

HEADLINE = (
    "minute_to_day", "transform_day", "floor_and_average_duplicates", "outliers_to_null", "ffill_limited", "ffill_raw_rows",
    "hour_day_aggregate", "completeness_day", "dense_hourly_grid", "gap_statistics", "load_shift_state",
    "weather_left_join", "streaks", "streaks_across_days", "event_ids", "merge_intervals", "certainty_coverage",
    "pair_alarm", "rolling_block_share", "tm_setpoint_alarm", "heat_output", "relative_humidity", "daily_plant_cop",
    "hvac_cop", "upsert_keep_existing", "event_upsert",
)


def run(spark, name: str, sf: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    load_all()
    spark = build_session("bench", cpus)
    times = {}
    for name in names:
        run(spark, name, sf)
        times[name] = round(statistics.median(run(spark, name, sf) for _ in range(repeats)), 3)
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": cpus, "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "driver_memory": spark.conf.get("spark.driver.memory")}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Stored tables, streams and whole runs."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.model import ALARMS, READINGS, SCHEDULE, complete_rows, ratio, to_wide
from wattloom.operators import aggregates, cleaning
from wattloom.plans import central
from wattloom.sinks import alarm_store, events, upsert
from wattloom.streaming import incremental

DAY = datetime(2024, 1, 3)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def readings(spark, *rows):
    return spark.createDataFrame([("s", at(m), v, x) for m, v, x in rows], READINGS)


def test_upsert_keeps_values_grows_and_touches_only_its_days(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "site string, ts timestamp_ntz, p double, q double"
    upsert.upsert(spark.createDataFrame([("s", at(0), 1.0, 2.0), ("s", at(2000), 5.0, 6.0)], schema), path)
    other_day = next((tmp_path / "t" / "date=2024-01-04").glob("*.parquet")).name
    upsert.upsert(spark.createDataFrame([("s", at(0), None, 3.0, 9.0), ("s", at(1), float("inf"), 4.0, None)], schema + ", r double"), path)
    got = rows(upsert.read_table(spark, path), "ts", "p", "q", "r")
    assert got == [(at(0), 1.0, 3.0, 9.0), (at(1), None, 4.0, None), (at(2000), 5.0, 6.0, None)]
    assert next((tmp_path / "t" / "date=2024-01-04").glob("*.parquet")).name == other_day


def test_upsert_twice_changes_nothing(spark, tmp_path, rows):
    path, df = str(tmp_path / "t"), readings(spark, (0, "p", 1.0), (1, "p", 2.0))
    upsert.load_readings(df, path)
    upsert.load_readings(df, path)
    assert rows(upsert.read_table(spark, path), "ts", "value") == [(at(0), 1.0), (at(1), 2.0)]


def test_columns_without_values_are_dropped(spark):
    df = spark.createDataFrame([("s", 1.0, None)], "site string, p double, q double")
    assert upsert.without_empty_columns(df, ["site"]).columns == ["site", "p"]


STORED = ("id bigint, site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, event_detail string, "
          "variable_name string, last_modified_by string, last_modified_date timestamp_ntz")
NEW = "site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, event_detail string, variable_name string"


def test_events_update_insert_and_respect_edits(spark, rows):
    stored = spark.createDataFrame([
        (1, "s", at(0), at(1), "ALARM", "long detail that goes on: 5", "v", "automatic_upload", at(0)),
        (2, "s", at(0), at(1), "ALARM", "edited by hand", "w", "someone", at(0)),
        (3, "s", at(0), at(1), "ALARM", "no variable", None, "automatic_upload", at(0))], STORED)
    new = spark.createDataFrame([
        ("s", at(0), at(9), "ALARM", "long detail that goes on: 7", "v"), ("s", at(0), at(9), "ALARM", "edited by hand", "w"),
        ("s", at(0), at(9), "ALARM", "no variable", None), ("s", at(5), None, "DATA_LOSS_COP", "fresh", None)], NEW)
    got = rows(events.upsert_events(stored, new, F.lit("2024-02-01").cast("timestamp_ntz"), detail_chars=20),
               "start_time_pt", "end_time_pt", "event_detail", "last_modified_by", "summary_filtered")
    assert got == [
        (at(0), at(1), "edited by hand", "someone", None), (at(0), at(9), "long detail that goes on: 7", "automatic_upload", None),
        (at(0), at(9), "no variable", "automatic_upload", None), (at(5), None, "fresh", "automatic_upload", True)]
    # two events that share a beginning are two events, by the whole detail and by a short match
    pair = spark.createDataFrame([("s", at(7), at(9), "ALARM", f"Technician replaced {x}", None) for x in ("pump A", "valve B")], NEW)
    for chars in (None, 10):
        out = events.upsert_events(stored, pair, F.lit("2024-02-01").cast("timestamp_ntz"), detail_chars=chars)
        assert out.where("start_time_pt = TIMESTAMP_NTZ'2024-01-03 00:07:00'").select("id").distinct().count() == 2
    with pytest.raises(Exception, match="unknown event type"):
        events.upsert_events(stored, new.withColumn("event_type", F.lit("OTHER"))).collect()


def alarm(spark, *rows):
    return spark.createDataFrame([("s", at(a), at(b), "T", "d", "v", c) for a, b, c in rows], ALARMS)


def test_alarm_parents_extend_keep_ids_and_cut_segments(spark, tmp_path, rows):
    base, day = str(tmp_path), 1440
    paths = (f"{base}/alarm", f"{base}/inst")
    alarm_store.load_alarms(alarm(spark, (0, 10, 2), (20 * day, 20 * day + 5, 3)), *paths)
    first = rows(spark.read.parquet(paths[0]), "start_time_pt", "end_time_pt", "id")
    alarm_store.load_alarms(alarm(spark, (5, 7, 3), (8, 30, 1), (4 * day + 9, 4 * day + 12, 1), (9 * day, 9 * day + 1, 1)), *paths)
    parents = rows(spark.read.parquet(paths[0]), "start_time_pt", "end_time_pt", "id")
    assert [(p[0], p[1]) for p in parents] == [(at(0), at(4 * day + 12)), (at(9 * day), at(9 * day + 1)), (at(20 * day), at(20 * day + 5))]
    assert parents[0][2] == first[0][2] and parents[2][2] == first[1][2]
    parts = rows(spark.read.parquet(paths[1]).where(f"id = {first[0][2]}"), "start_time_pt", "end_time_pt", "certainty")
    assert parts == [(at(0), at(5), 2), (at(5), at(7), 3), (at(7), at(10), 2), (at(10), at(30), 1), (at(4 * day + 9), at(4 * day + 12), 1)]


def test_fill_rules_limits_and_seeds(spark, rows):
    df = readings(spark, *[(i, v, x) for v in ("a", "b", "c", "d") for i, x in enumerate([None, 1.0, None, None, None])])
    rules = spark.createDataFrame([("a", 1, None), ("b", 0, 2), ("c", None, 3), ("d", 0, None)],
                                  "variable_name string, changepoint int, ffill_length int")
    wide = lambda out: {v: [x for _, x in rows(out.where(F.col("variable") == v), "ts", "value")] for v in ("a", "b", "c", "d", "e")}
    got = wide(cleaning.forward_fill(df, rules))
    assert got["a"] == [None, 1.0, 1.0, 1.0, 1.0] and got["b"] == [None, 1.0, 1.0, 1.0, None]
    assert got["c"] == got["d"] == [None, 1.0, None, None, None]
    seed = spark.createDataFrame([("s", "a", 7.0), ("s", "b", 8.0), ("s", "e", 9.0)], "site string, variable string, value double")
    got = wide(cleaning.forward_fill(df, rules.unionByName(spark.createDataFrame([("e", 1, 1)], rules.schema)), seed=seed))
    assert got["a"][0] == 7.0 and got["b"][0] == 8.0 and got["e"] == [9.0] * 5


def test_bounds_are_inclusive_and_one_sided(spark, rows):
    df = readings(spark, (0, "a", 1.0), (1, "a", 5.0), (2, "a", 5.1), (3, "a", None), (4, "b", -9.0))
    rules = spark.createDataFrame([("a", 1.0, 5.0), ("b", None, 0.0)], "variable_name string, lower_bound double, upper_bound double")
    assert [x for _, x in rows(cleaning.outliers_to_null(df, rules), "ts", "value")] == [1.0, 5.0, None, None, -9.0]


def test_rules_of_another_site_do_not_apply(spark, rows):
    df = readings(spark, (0, "a", 9.0))
    rules = spark.createDataFrame([("other", "a", 1.0, 5.0)], "site string, variable_name string, lower_bound double, upper_bound double")
    assert rows(cleaning.outliers_to_null(df, rules), "value") == [(9.0,)]


def test_daylight_saving_hours_fall_together(spark, rows):
    df = spark.createDataFrame([("s", datetime(2024, 11, 3, h), "a", float(h)) for h in (8, 9, 10)], READINGS)
    out = cleaning.average_duplicates(cleaning.shift_zone(df))
    assert rows(out, "ts", "value") == [(datetime(2024, 11, 3, 1), 8.5), (datetime(2024, 11, 3, 2), 10.0)]


def test_dense_grid_sums_energy_to_zero(spark, rows):
    df = readings(spark, (0, "Energy_x", 1.0), (30, "Energy_x", 2.0), (72 * 60, "Energy_x", 4.0), (0, "y", 2.0), (72 * 60, "y", 6.0),
                  (0, "EnergyRate", 5.0), (0, "Energy_BTU", 5.0))
    hours = aggregates.aggregate(df, "HOUR", dense=True)
    energy = rows(hours.where("variable = 'Energy_x'"), "ts", "value")
    assert len(energy) == 73 and energy[0][1] == 3.0 and energy[1][1] == 0.0
    assert {r[0] for r in rows(hours, "variable")} == {"Energy_x", "y"}
    assert rows(hours.where("variable = 'y'"), "ts", "value")[1][1] is None


def test_completeness_drops_hours_days_and_empties_variables(spark, rows):
    data = [(m, "a", 1.0) for m in range(1440)] + [(m, "b", None if m < 30 else 1.0) for m in range(1440)]
    data += [(m, v, 1.0) for m in range(1440, 1440 + 40) for v in ("a", "b")]
    hours, days = aggregates.hour_and_day(readings(spark, *data))
    assert hours.where("variable = 'a'").count() == 24
    assert rows(hours.where("variable = 'b'"), "ts", "value")[0][1] is None
    assert rows(days, "ts", "variable", "value") == [(DAY, "a", 1.0), (DAY, "b", None)]
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            aggregates.hour_and_day(readings(spark, (0, "a", 1.0)), hour_threshold=bad)
        with pytest.raises(ValueError):
            aggregates.hour_and_day(readings(spark, (0, "a", 1.0)), day_threshold=bad)


def test_gap_statistics_of_full_days_only(spark, rows):
    data = [(m, "a", 1.0) for m in range(-60, 2 * 1440) if not 10 <= m < 15 and m != 100]
    got = rows(aggregates.gap_statistics(readings(spark, *data, (2 * 1440 + 5, "a", 1.0))), "day", "missing_slots", "avg_gap", "max_gap")
    assert got == [(at(0), 6, 3.0, 5), (at(1440), 0, 0.0, 0)]


def test_wide_and_long_and_ratio(spark, rows):
    df = readings(spark, (0, "a", 1.0), (1, "b", 2.0))
    full = complete_rows(df)
    assert full.count() == 4
    assert rows(to_wide(full, ["a", "b"]), "ts", "a", "b") == [(at(0), 1.0, None), (at(1), None, 2.0)]
    cases = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (float("inf"), float("inf")), (3.0, 2.0), (None, 1.0)], "n double, d double")
    got = [r[0] for r in cases.select(ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [float("inf"), float("-inf"), None, None, 1.5, None]


# --- streams --------------------------------------------------------------------------------------

def stream_rows(spark, path, *rows):
    spark.createDataFrame(list(rows), "site string, ts timestamp, variable string, value double").write.mode("append").parquet(path)


def test_stream_hours_days_with_late_and_duplicate_rows(spark, tmp_path, rows):
    src = str(tmp_path / "in")
    minute = lambda m, v=1.0: ("s", at(m), "a", v)
    stream_rows(spark, src, *[minute(m, float(m // 60)) for m in range(2 * 1440)], minute(5, 2.0), *[minute(3 * 1440 + i * 720) for i in range(4)])
    for name, build in (("h", lambda d: incremental.complete_hours(d)), ("d", lambda d: incremental.complete_days(d))):
        stream = incremental.read_stream(spark, src)
        q = build(stream).writeStream.format("memory").queryName(name).outputMode("append").option(
            "checkpointLocation", str(tmp_path / f"cp_{name}")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    hours = rows(spark.table("h"), "ts", "value")
    assert len(hours) == 48
    days = rows(spark.table("d"), "ts", "value")
    assert days[0] == (at(0), pytest.approx(11.5 + 1 / 1440))  # two copies of one minute, 0 and 2, average to 1


def test_stream_streaks_count_in_time_order(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), []
    first = [("s", at(m), "a", 1.0 if m in (1, 2, 3, 7, 8, 9, 10) else 0.0) for m in (9, 3, 1, 7, 2, 8, 4, 5, 6, 0, 10, 11)]
    for batch in (first, [("s", at(60), "a", 0.0)], [("s", at(120), "a", 0.0)]):
        stream_rows(spark, src, *batch)
        q = incremental.streak_stream(incremental.read_stream(spark, src), "value = 1", 3).writeStream.foreachBatch(
            lambda df, _: out.extend(tuple(r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    assert sorted(out) == [("s", "a", at(1), at(3), 3), ("s", "a", at(7), at(10), 4)]


def test_files_are_ingested_once(spark, tmp_path, rows):
    src, target, cp = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    src.mkdir()
    (src / "a.csv").write_text("DateTime,p\n2024/01/03 00:00:00,1\n2024/01/03 00:01:00,2\n")
    assert incremental.ingest_files(spark, str(src), "csv", "s", target, cp).awaitTermination(120)
    (src / "b.csv").write_text("DateTime,p,q\n2024/01/03 00:01:00,5,6\n")
    assert incremental.ingest_files(spark, str(src), "csv", "s", target, cp).awaitTermination(120)
    assert rows(upsert.read_table(spark, target), "ts", "variable", "value") == [
        (at(0), "p", 1.0), (at(1), "p", 5.0), (at(1), "q", 6.0)]


@pytest.mark.parametrize("kind", ["csv", "csv_mb", "csv_egauge"])
def test_files_per_batch_change_nothing(spark, tmp_path, rows, kind):
    src = tmp_path / "in"
    src.mkdir()
    head = {"csv": "DateTime", "csv_mb": "time(UTC)", "csv_egauge": "Date & Time"}[kind]
    moment = (lambda m: str(1704240000 + 60 * m)) if kind == "csv_egauge" else (lambda m: at(m).strftime("%Y/%m/%d %H:%M:%S"))
    # the second file comes between rows of the first one, and empties a known register
    for k, values in enumerate(({0: "1", 1: "5", 4: "20"}, {1: "9", 3: ""}, {2: "12", 1500: "30"})):
        (src / f"d.{k}.csv").write_text("\n".join([f"{head},p", *(f"{moment(m)},{v}" for m, v in values.items())]) + "\n")
        os.utime(src / f"d.{k}.csv", (1_700_000_000 + 10 * k,) * 2)
    got = []
    for files in (1, 10):
        target = str(tmp_path / f"t{files}")
        assert incremental.ingest_files(
            spark, str(src), kind, "s", target, str(tmp_path / f"cp{files}"), files_per_batch=files).awaitTermination(120)
        got.append(rows(upsert.read_table(spark, target), "ts", "variable", "value"))
    assert got[0] == got[1]
    want = {"csv": [1.0, 9.0, 12.0, None, 20.0, 30.0], "csv_mb": [1.0, 7.0, 12.0, None, 20.0, 30.0], "csv_egauge": [None, 6.0, 5.0, None, None, 10.0]}
    assert [r[2] for r in sorted(got[0])] == want[kind]


def test_readings_per_batch_change_nothing(spark, tmp_path, rows):
    src, got = str(tmp_path / "in"), []
    for value in (1.0, 3.0, 8.0):
        stream_rows(spark, src, ("s", at(0), "a", value))
    for files in (1, 10):
        target = str(tmp_path / f"t{files}")
        stream = incremental.read_stream(spark, src, files_per_batch=files)
        assert incremental.upsert_batches(stream, target, str(tmp_path / f"cp{files}")).awaitTermination(120)
        got.append(rows(upsert.read_table(spark, target), "ts", "value"))
    assert got == [[(at(0), 4.0)]] * 2


@pytest.mark.parametrize("order", ["in time", "shuffled", "backwards"])
def test_stored_periods_do_not_depend_on_arrival(spark, tmp_path, rows, order):
    """Rows of two days and sites, a third of them late, in eight batches; two rows of one minute in different batches."""
    rng = random.Random(order)
    data = [("s", at(m), v, float((m // 7) % 5)) for m in range(2 * 1440) for v in ("a", "Energy_b") if m % 53 or v == "a"]
    data += [("s", at(5), "a", 7.0), ("t", at(30), "a", 1.0), ("t", at(31), "a", None), ("s", at(1500), "only_here", 3.0)]
    arrival = list(data)
    if order == "shuffled":
        rng.shuffle(arrival)
    elif order == "backwards":
        arrival.reverse()
    src, target = str(tmp_path / "in"), str(tmp_path / "t")
    size = -(-len(arrival) // 8)
    rules = {"low": ("value = 0", 3), "high": ("value >= 3", 4)}
    for a in range(0, len(arrival), size):
        stream_rows(spark, src, *arrival[a:a + size])
        stream = incremental.read_stream(spark, src, files_per_batch=1000)
        assert incremental.store_periods(stream, target, str(tmp_path / "cp"), rules=rules).awaitTermination(180)
    df = spark.createDataFrame(data, READINGS)
    minute = cleaning.average_duplicates(df)
    assert rows(upsert.read_table(spark, f"{target}/minute"), "site", "ts", "variable", "value") == rows(minute, "site", "ts", "variable", "value")
    hour, day = aggregates.of_parts(incremental.reported_parts(minute))
    for name, want in (("hour", hour), ("day", day)):
        got = rows(upsert.read_table(spark, f"{target}/{name}"), "site", "ts", "variable", "value")
        assert [r[:3] for r in got] == [r[:3] for r in (rows(want, "site", "ts", "variable", "value"))]
        assert all(a[3] == (b[3] if b[3] is None else pytest.approx(b[3])) for a, b in zip(got, rows(want, "site", "ts", "variable", "value"), strict=True))
    columns = ("site", "variable", "rule", "start", "end", "length")
    assert rows(incremental.stored_streaks(spark, target), *columns) == rows(incremental.day_streaks(minute, rules), *columns)
    assert day.where("variable = 'Energy_b'").count() == 2


def test_reported_parts_equal_those_of_complete_rows(spark, rows):
    df = readings(spark, *[(m, v, float(m % 4)) for m in range(300) for v in "ab" if (m * 7 + ord(v)) % 3], (3, "Energy_c", 2.0), (3, "EnergyRate_c", 2.0))
    want = aggregates.hour_parts(complete_rows(df))
    columns = ("site", "variable", "hour", "_sum", "_values", "_rows")
    assert rows(incremental.reported_parts(df), *columns) == rows(want, *columns)


# --- whole runs -----------------------------------------------------------------------------------

RULES = "variable_alias string, variable_name string, changepoint int, ffill_length int"


def test_transform_order_hooks_weather_and_labels(spark, rows):
    raw = readings(spark, *[(m, "x", 100.0) for m in range(1440)], *[(m, "junk", 1.0) for m in range(10)])
    rules = spark.createDataFrame([("x", "Temp_x", 1, None)], RULES)
    oat = spark.createDataFrame([("s", at(60 * h), 40.0 + h) for h in range(48)], "site string, ts timestamp_ntz, OAT_NOAA double")
    plan = spark.createDataFrame([("s", "shed", at(60), at(120), 0)], SCHEDULE)
    out = central.transform(raw, rules, schedule=plan, weather=oat, oat="OAT_NOAA", pre_aggregation=lambda d: d.withColumn("value", F.col("value") / 2))
    assert {r[0] for r in rows(out.hour, "variable")} == {"Temp_x", "OAT_NOAA"}
    assert rows(out.day, "variable", "value") == [("OAT_NOAA", 51.5), ("Temp_x", 50.0)]
    assert rows(out.hour_state.where("system_state = 'shed'"), "ts") == [(at(60),)]
    assert rows(out.day_flag, "load_shift_day") == [(True,)]
    with pytest.raises(TypeError):
        central.transform(raw, rules, pre_aggregation=lambda d: None)
    with pytest.raises(TypeError):
        central.transform(raw, rules, post_aggregation=lambda m, h, d: (m, h))
    same = central.transform(raw, rules, post_aggregation=lambda m, h, d: (m, h, d.where("false")))
    assert same.day.count() == 0


def test_run_from_files_to_tables(spark, tmp_path, rows):
    src = tmp_path / "in"
    src.mkdir()
    lines = [f"2024/01/03 {m // 60:02d}:{m % 60:02d}:00,{140 if m < 20 else 120}" for m in range(1440)]
    (src / "a_20240103000000.csv").write_text("DateTime,x\n" + "\n".join(lines) + "\n")
    rules = spark.createDataFrame([("x", "Temp_x", 1, None, "TMPRANG")], RULES + ", alarm_codes string")
    raw = central.extract(spark, "csv", str(src), "s", name_start=-18, name_end=-4)
    tables = central.transform(raw, rules)
    found = central.find_alarms(tables, rules)
    central.load(tables, str(tmp_path / "out"), found, aggregates.gap_statistics(tables.minute))
    assert rows(spark.read.parquet(str(tmp_path / "out" / "alarm")), "start_time_pt", "end_time_pt") == [(at(0), at(20))]
    assert spark.read.parquet(str(tmp_path / "out" / "hour")).count() == 24
    stored = spark.read.parquet(str(tmp_path / "out" / "minute"))
    again = central.extract(spark, "csv", str(src), "s", stored=stored, name_start=-18, name_end=-4)
    assert again.count() == 0
    both = central.extract(spark, "csv", str(src), "s", stored=stored, reprocess=True, name_start=-18, name_end=-4)
    assert both.count() == 1440


def test_touched_dates_and_later_files_only(spark, tmp_path, rows):
    path = str(tmp_path / "stored")
    upsert.load_readings(readings(spark, (0, "a", 1.0), (1440, "a", 2.0), (2880, "a", 3.0)), path)
    run = readings(spark, (1441, "a", 5.0)).withColumn("date", F.to_date("ts"))
    plan = upsert.touched(upsert.read_table(spark, path), run)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-04" in plan
    src = tmp_path / "in"
    src.mkdir()
    for day in ("02", "03", "04"):
        (src / f"x_202401{day}000000.csv").write_text(f"DateTime,p\n2024/01/{day} 12:00:00,1\n")
    stored = readings(spark, (1439, "p", 1.0))
    out = central.extract(spark, "csv", str(src), "s", stored=stored, name_start=-18, name_end=-4)
    assert rows(out, "ts") == [(datetime(2024, 1, 4, 12),)]


def test_fill_reaches_the_rows_of_other_devices(spark, rows):
    """A gap in one device's file is filled at the times of another's."""
    raw = readings(spark, (0, "a", 1.0), (1, "b", 5.0), (2, "b", 6.0))
    rules = spark.createDataFrame([(v, v, 1, None) for v in "ab"], "variable_alias string, variable_name string, changepoint int, ffill_length int")
    out = central.transform(raw, rules, settle=False)
    assert rows(out.minute.where("variable = 'a'"), "ts", "value") == [(at(0), 1.0), (at(1), 1.0), (at(2), 1.0)]


def test_two_aliases_of_a_name_have_one_rule(spark, rows):
    rules = spark.createDataFrame([("a1", "x", 0.0, 9.0), ("a2", "x", 0.0, 9.0)], "variable_alias string, variable_name string, lower_bound double, upper_bound double")
    raw = readings(spark, (0, "x", 5.0), (1, "x", 50.0))
    assert rows(cleaning.outliers_to_null(raw, rules), "ts", "value") == [(at(0), 5.0), (at(1), None)]
    odd = rules.unionByName(rules.limit(1).withColumn("upper_bound", F.lit(1.0)))
    with pytest.raises(Exception, match="rules disagree"):
        cleaning.outliers_to_null(raw, odd).collect()


def test_alarms_without_certainty_or_length_stay(spark, rows):
    new = alarm(spark, (0, 5, None), (9, 9, 2))
    parents, segments = alarm_store.alarm_tables(new)
    assert rows(segments, "start_time_pt", "end_time_pt", "certainty") == [(at(0), at(5), 3), (at(9), at(9), 2)]
    assert parents.count() == 1
    with pytest.raises(Exception, match="unknown certainty"):
        alarm_store.alarm_tables(new.withColumn("certainty", F.lit(7)))[1].collect()

"""Stores whose loads show as a whole or not at all."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.model import ALARMS
from wattloom.sinks import alarm_store, events, upsert, versions

JAN = datetime(2024, 1, 10)
EVENT = "site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, event_detail string, variable_name string"


def event(spark, *rows):
    return spark.createDataFrame([("s", JAN + timedelta(days=d), None if e is None else JAN + timedelta(days=e), "MISC_EVENT", t, None)
                                  for d, e, t in rows], EVENT)


def now(day):
    return F.lit((JAN + timedelta(days=day)).isoformat(sep=" ")).cast("timestamp_ntz")


def shown(spark, path):
    return sorted((r.start_time_pt, r.end_time_pt, r.event_detail, r.last_modified_by) for r in events.stored_events(spark, path).collect())


def test_event_loads_touch_their_months_only(spark, tmp_path):
    path = str(tmp_path / "e")
    assert events.load_events(event(spark, (0, 1, "a"), (40, None, "b")), path, now=now(41)) == 1
    first = {e.part: e.folder for e in versions.entries(spark, path)}
    assert set(first) == {"2024-01", "2024-02"}
    events.load_events(event(spark, (40, 44, "b"), (100, 101, "c")), path, now=now(101))
    second = {e.part: e.folder for e in versions.entries(spark, path)}
    assert second["2024-01"] == first["2024-01"] and second["2024-02"] != first["2024-02"] and set(second) == {"2024-01", "2024-02", "2024-04"}
    at = lambda d: JAN + timedelta(days=d)
    assert shown(spark, path) == [(at(0), at(1), "a", events.UPLOADER), (at(40), at(44), "b", events.UPLOADER), (at(100), at(101), "c", events.UPLOADER)]


def test_a_failed_load_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "e")
    events.load_events(event(spark, (0, 1, "a")), path, now=now(2))
    before = shown(spark, path)
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            events.load_events(event(spark, (0, 9, "a"), (1, 2, "new")), path, now=now(3))
    broken = F.raise_error(F.lit("a task failed"))
    with pytest.raises(Exception, match="a task failed"):
        versions.write(event(spark, (0, 9, "x")).withColumn("id", F.when(F.col("site") == "s", broken).cast("long")), path,
                       versions.month("start_time_pt"), F.col("end_time_pt"), versions.entries(spark, path), {"2024-01"})
    assert shown(spark, path) == before
    with pytest.raises(ValueError, match="OTHER"):
        events.load_events(event(spark, (0, 9, "a")).withColumn("event_type", F.lit("OTHER")), path)
    assert events.load_events(event(spark, (0, 9, "a")), path, now=now(3)) == 2
    assert [r[1] for r in shown(spark, path)] == [JAN + timedelta(days=9)]


def test_of_two_loads_of_one_version_one_wins(spark, tmp_path):
    path = str(tmp_path / "e")
    old = versions.entries(spark, path)
    rows = event(spark, (0, 1, "a"))
    part, reach = versions.month("start_time_pt"), F.col("end_time_pt")
    versions.write(rows, path, part, reach, old, set())
    outcomes = []
    for _ in range(4):  # the names of loads are random; either side may win, but only one
        try:
            versions.write(rows, path, part, reach, old, set())
            outcomes.append("won")
        except versions.Conflict:
            outcomes.append("lost")
    assert len(versions.entries(spark, path)) == 1
    assert versions.entries(spark, path)[0].version == 1


def test_store_all_writes_events_and_data_losses(spark, tmp_path):
    base = str(tmp_path / "out")
    minute = spark.createDataFrame([("s", JAN, "a", 1.0), ("t", JAN + timedelta(days=8), "a", 1.0)], "site string, ts timestamp_ntz, variable string, value double")
    upsert.store_all(base, minute=minute, events=event(spark, (0, 1, "a")), data_loss=True, now=now(9))
    upsert.store_all(base, minute=minute, data_loss=True, now=now(10))
    upsert.store_all(base, minute=minute.where("site = 's'"), now=now(10))
    got = sorted((r.site, r.event_type, r.start_time_pt, r.summary_filtered) for r in events.stored_events(spark, f"{base}/site_events").collect())
    assert got == [("s", "DATA_LOSS_COP", JAN + timedelta(days=9), True), ("s", "MISC_EVENT", JAN, False)]


def alarms(spark, rows):
    return spark.createDataFrame([("s", JAN + timedelta(hours=a), JAN + timedelta(hours=b), "TMPRANG", "d", v, c) for a, b, v, c in rows], ALARMS)


def plain(parents, segments):
    return (sorted(map(tuple, parents.drop("id").collect())), sorted(map(tuple, segments.drop("id").collect())))


def test_alarm_history_reads_and_writes_what_is_in_reach(spark, tmp_path):
    path, day = str(tmp_path / "h"), 24
    alarm_store.load_history(alarms(spark, [(0, 5, "x", 3), (25 * day, 60 * day, "x", 2), (100 * day, 101 * day, "y", 1)]), path)
    folders = {e.part: e.folder for e in versions.entries(spark, path)}
    assert set(folders) == {"2024-01", "2024-02", "2024-04"}
    # the session of February reaches into March; April and January are out of reach
    assert alarm_store.load_history(alarms(spark, [(61 * day, 62 * day, "x", 3)]), path) == {"2024-02"}
    later = {e.part: e.folder for e in versions.entries(spark, path)}
    assert {p for p in later if later[p] != folders.get(p)} == {"2024-02"}
    # an alarm that joins January's session with February's moves the latter to January
    assert alarm_store.load_history(alarms(spark, [(2 * day, 22 * day, "x", 1)]), path) == {"2024-01", "2024-02"}
    assert {e.part for e in versions.entries(spark, path)} == {"2024-01", "2024-04"}
    assert alarm_store.load_history(alarms(spark, []), path) == set()


@pytest.mark.parametrize("seed", [1, 2])
def test_alarm_history_in_any_order_is_the_same(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(h := rng.randint(0, 24 * 150), h + rng.choice([1, 20, 24 * 40]), rng.choice("xy"), rng.randint(1, 3)) for _ in range(40)]
    want = plain(*alarm_store.alarm_tables(alarms(spark, rows)))
    rng.shuffle(rows)
    path = str(tmp_path / "h")
    for a in range(0, 40, 10):
        alarm_store.load_history(alarms(spark, rows[a:a + 10]), path)
    assert plain(*alarm_store.stored_history(spark, path)) == want

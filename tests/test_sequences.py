"""Stateful rules against plain restatements, on random series cut into segments."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom.model import READINGS, SCHEDULE
from wattloom.operators import hvac, intervals, joins, sequences

START = datetime(2024, 3, 9, 20, 0)


def series(seed, n=120):
    rng = random.Random(seed)
    out, t = [], START
    for _ in range(n):
        t += timedelta(minutes=rng.choice([1, 1, 1, 2, 9, 11, 40]))
        out.append((t, rng.choice([None, 0.0, 1.0, 1.0])))
    return out


@pytest.fixture(scope="module")
def many():
    return {(f"s{i % 3}", f"v{i}"): series(i) for i in range(12)}


@pytest.fixture(scope="module")
def frame(spark, many):
    data = [(s, t, v, x) for (s, v), rows in many.items() for t, x in rows]
    return spark.createDataFrame(data, READINGS)


def segments():
    return {"none": None, "hour": sequences.hour_segment(), "day": sequences.day_segment()}


@pytest.mark.parametrize("cut", ["none", "hour", "day"])
def test_ordered(frame, many, cut):
    v = F.col("value")
    out = sequences.ordered(
        frame, ["site", "variable"], ["ts"], segments()[cut], lag={"prev": v}, lead={"next": v}, last={"latest": v},
        total={"sum": v}, highest_before={"top": v}, rows_since={"age": v == 1}).collect()
    got = {}
    for r in out:
        got.setdefault((r.site, r.variable), {})[r.ts] = (r.prev, r.next, r.latest, r["sum"], r.top, r.age)
    for key, rows in many.items():
        xs = [x for _, x in rows]
        for i, (t, _) in enumerate(rows):
            past = [x for x in xs[:i] if x is not None]
            upto = [x for x in xs[:i + 1] if x is not None]
            ones = [j for j in range(i + 1) if xs[j] == 1.0]
            want = (xs[i - 1] if i else None, xs[i + 1] if i + 1 < len(xs) else None, upto[-1] if upto else None,
                    sum(upto) if upto else None, max(past) if past else None, i - ones[-1] if ones else i + 1)
            assert got[key][t] == want, (key, i)


def test_rows_with_a_null_key_stay_one_series(spark):
    rows = [(None, START + timedelta(hours=h), "v", float(h)) for h in range(30)] + [("", START, "v", 9.0)]
    df = spark.createDataFrame(rows, READINGS)
    out = sequences.ordered(df, ["site", "variable"], ["ts"], sequences.day_segment(), lag={"prev": F.col("value")}).collect()
    assert len(out) == 31
    assert sorted(r.prev for r in out if r.site is None and r.prev is not None) == [float(h) for h in range(29)]
    assert [r.prev for r in out if r.site == ""] == [None]


def rolling_streaks(rows, need):
    """n-row rolling minimum, then runs of it, per day."""
    found = []
    for day in sorted({t.date() for t, _ in rows}):
        part = [(t, x == 1.0) for t, x in rows if t.date() == day]
        full = [i >= need - 1 and all(h for _, h in part[i - need + 1:i + 1]) for i in range(len(part))]
        i = 0
        while i < len(part):
            if full[i]:
                j = i
                while j + 1 < len(part) and full[j + 1]:
                    j += 1
                found.append((part[i][0] - timedelta(minutes=need - 1), part[j][0], j - i + need))
                i = j
            i += 1
    return found


@pytest.mark.parametrize("need", [1, 2, 4])
def test_streaks_equal_rolling_windows(frame, many, need):
    df = frame.withColumn("hit", F.col("value") == 1).withColumn("day", F.to_date("ts"))
    got = sequences.streaks(df, "hit", need, ["site", "variable", "day"]).collect()
    for key, rows in many.items():
        mine = sorted((r.start, r.end, r.length) for r in got if (r.site, r.variable) == key)
        assert mine == sorted(rolling_streaks(rows, need))


@pytest.mark.parametrize("cut", ["none", "hour", "day"])
def test_event_numbers(spark, frame, many, cut):
    one = frame.where("site = 's0' AND variable = 'v0'")
    got = {r.ts: r.event_id for r in sequences.event_ids(one, F.col("value") == 1, segment=segments()[cut]).collect()}
    rows = many[("s0", "v0")]
    flags = [1 if x == 1.0 else 0 for _, x in rows]
    number, ids = 1, [flags[0]]
    for i in range(1, len(rows)):
        if flags[i]:
            if rows[i][0] - rows[i - 1][0] > timedelta(minutes=10):
                number += 1
        elif ids[i - 1] > 0:
            number += 1
        ids.append(number)
    assert [got[t] for t, _ in rows] == ids
    runs = {r.ts: r.event_id for r in sequences.event_ids(one, F.col("value") == 1, segment=segments()[cut], mode="runs").collect()}
    want, n = [], 0
    for i, f in enumerate(flags):
        n += i == 0 or f != flags[i - 1]
        want.append(n)
    assert [runs[t] for t, _ in rows] == want


@pytest.mark.parametrize("cut", ["none", "hour"])
def test_short_runs_skip_the_edges(frame, many, cut):
    df = frame.withColumn("hit", F.col("value") == 1)
    got = sequences.short_runs(df, "hit", 3, ["site", "variable"], segment=segments()[cut]).collect()
    for key, rows in many.items():
        want, i = [], 0
        while i < len(rows):
            if rows[i][1] == 1.0:
                j = i
                while j + 1 < len(rows) and rows[j + 1][1] == 1.0:
                    j += 1
                if j - i + 1 < 3 and i > 0 and j < len(rows) - 1:
                    want.append((rows[i][0], rows[j][0], j - i + 1))
                i = j
            i += 1
        assert sorted((r.start, r.end, r.length) for r in got if (r.site, r.variable) == key) == want


@pytest.fixture(scope="module")
def spans():
    rng = random.Random(7)
    out = []
    for i in range(150):
        a = START + timedelta(minutes=rng.randrange(0, 4000))
        out.append((f"s{i % 4}", a, a + timedelta(minutes=rng.randrange(1, 120)), rng.choice([1, 2, 3])))
    return out


def test_coverage_is_the_highest_certainty_of_each_minute(spark, spans):
    df = spark.createDataFrame(spans, "site string, start timestamp_ntz, end timestamp_ntz, certainty int")
    got = intervals.certainty_coverage(df, ["site"]).collect()
    for site in ("s0", "s1", "s2", "s3"):
        want, mine = {}, {}
        for s, a, b, c in spans:
            if s == site:
                t = a
                while t < b:
                    want[t] = max(want.get(t, 0), c)
                    t += timedelta(minutes=1)
        for r in got:
            if r.site == site:
                t = r.start
                while t < r.end:
                    assert t not in mine
                    mine[t] = r.certainty
                    t += timedelta(minutes=1)
        assert mine == want


@pytest.mark.parametrize("gap", [1, 30])
def test_merging_equals_the_greedy_loop(spark, spans, gap):
    df = spark.createDataFrame(spans, "site string, start timestamp_ntz, end timestamp_ntz, certainty int")
    near = F.col("start") <= F.col("_reach") + F.expr(f"INTERVAL '{gap}' MINUTE")
    for seg in (None, F.to_date("start")):
        got = sorted((r.site, r.start, r.end) for r in intervals.merge_touching(df, ["site"], near, segment=seg).collect())
        want = []
        for site in sorted({s[0] for s in spans}):
            current = None
            for _, a, b, _ in sorted(x for x in spans if x[0] == site):
                if current and a <= current[1] + timedelta(minutes=gap):
                    current[1] = max(current[1], b)
                else:
                    if current:
                        want.append((site, *current))
                    current = [a, b]
            want.append((site, *current))
        assert got == sorted(want)


@pytest.mark.parametrize("seed", range(4))
def test_disjoint_windows_keep_the_highest_priority(spark, seed):
    rng = random.Random(seed)
    at = lambda m: START + timedelta(minutes=m)
    n, wide = (120, 60) if seed else (40, 3000)  # many on few edges; few over many weeks
    rows = [(rng.choice("ab"), rng.choice("xyz"), (m := rng.randint(0, 30 * wide)), m + rng.randint(0, 10 * wide), rng.randint(0, 50)) for _ in range(n)]
    odd = [("a", None, 0, 9, 99), ("a", "x", 9, 9, 99), ("a", "x", 0, 9, None), ("c", "only", 1, 2, 1)]
    windows = spark.createDataFrame([(s, e, at(a), at(b), p) for s, e, a, b, p in rows + odd], SCHEDULE)
    got = [tuple(r) for r in intervals.disjoint(windows).collect()]
    for site in "abc":
        mine = sorted((r[1], r[2], r[4], r[3]) for r in got if r[0] == site)
        assert all(x[1] <= y[0] for x, y in zip(mine, mine[1:]))
        for a, b, p, e in mine:
            open_ = [(w[4], w[1]) for w in rows + odd[3:] if w[0] == site and at(w[2]) <= a and b <= at(w[3])]
            assert (p, e) == max(open_)
        covered = sum(((b - a) for a, b, *_ in mine), timedelta())
        minutes = {m for w in rows + odd[3:] if w[0] == site for m in range(w[2], w[3])}
        assert covered == timedelta(minutes=len(minutes))
    assert intervals.disjoint(windows.where("false")).count() == 0


def test_few_keys_are_dealt_into_parts(spark):
    df = spark.createDataFrame([("a", i) for i in range(200)] + [("b", 200), (None, 201)], "k string, n int")
    few = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "k string, m int")
    for how in ("inner", "left"):
        want, got = df.join(few, ["k"], how), joins.join_few(df, few, ["k"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    parts = df.join(few, "k").withColumn("p", F.monotonically_increasing_id() % joins.PARTS).select("p").distinct().count()
    assert parts == joins.PARTS
    with pytest.raises(ValueError):
        joins.join_few(df, few, ["k"], "full")


def test_overlapping_windows_are_met_in_many_tasks(spark):
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    read = [(f"s{h % 3}", at(h), "v", float(h)) for h in range(0, 240, 5)] + [(None, at(1), "v", 0.0), ("s0", None, "v", 0.0)]
    spans = [(f"s{i % 3}", "e", at(i), at(i + 40), i) for i in range(200)] + [(None, "e", at(0), at(9), 900), ("s0", "e", at(9), at(9), 901)]
    df, windows = spark.createDataFrame(read, READINGS), spark.createDataFrame(spans, SCHEDULE)
    want = sorted((r[0], r[1], w[4]) for r in read for w in spans if r[0] and r[0] == w[0] and r[1] and w[2] <= r[1] < w[3])
    met = intervals.inside(df, windows)
    assert sorted((r["site"], r["ts"], r["seq"]) for r in met.collect()) == want
    assert met.select(F.spark_partition_id().alias("p")).distinct().count() > 8  # before, a broadcast left all rows to the readings' tasks
    kept = intervals.inside(df, windows, "left")
    assert kept.where("seq IS NOT NULL").count() == len(want)
    assert kept.where("seq IS NULL").count() == sum(all(w[0] != r[0] or not r[0] or not r[1] or not w[2] <= r[1] < w[3] for w in spans) for r in read)


def test_overlapping_windows_take_little_disk(spark, tmp_path):
    """All windows around a reading don't come before the next reading, so a column format finds what repeats."""
    minute, start = F.make_dt_interval(mins=F.lit(1)), F.lit(START)
    df = spark.range(300).select(F.lit("a").alias("site"), (start + minute * (F.col("id") % 150)).alias("ts"), F.col("id").cast("double").alias("value"))
    windows = spark.range(5_000).select(
        F.lit("a").alias("site"), F.lit("shed").alias("event"), start.alias("start"), (start + minute * (50 + F.col("id") % 100)).alias("end"), F.col("id").alias("seq"))
    met = intervals.inside(df, windows)
    assert met.columns == ["site", "ts", "value", "event", "start", "end", "seq"]
    met.select("site", "ts", "value", "seq").write.parquet(out := str(tmp_path / "met"))
    got = spark.read.parquet(out).agg(F.count("*").alias("n"), F.sum("value").alias("value"), F.sum("seq").alias("seq")).first()
    want = [(v, q) for v in range(300) for q in range(5_000) if v % 150 < 50 + q % 100]
    assert tuple(got) == (len(want), sum(v for v, _ in want), sum(q for _, q in want))
    assert sum(f.stat().st_size for f in (tmp_path / "met").glob("*.parquet")) < 0.4 * len(want)


def test_airflow_deals_the_rows_of_a_site(spark):
    df = spark.createDataFrame([("s", i, "heat" if i % 2 else "cool", 0.5) for i in range(64)] + [("t", 1, "cool", 0.1)],
                               "site string, event_ID int, HVAC string, Power_AH1 double")
    cfm = spark.createDataFrame([("s", "heat", 900.0, "TRUE"), ("t", "cool", 400.0, "FALSE")],
                                "site string, mode string, ID_blower_cfm double, use_fan_curve string")
    sites = spark.createDataFrame([("s", 0.372), ("t", None)], "site string, furn_misc_power double")
    out = hvac.airflow(df, cfm, sites)
    assert "_part" in out._jdf.queryExecution().analyzed().toString()
    assert {(r.site, round(r.Cfm_Calc, 6)) for r in out.collect()} == {("s", round(128 ** (1 / 3), 6)), ("t", 400.0)} and out.count() == 65

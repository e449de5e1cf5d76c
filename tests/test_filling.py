"""Fill and aggregation of sparse rows against the wide frame they stand for."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from wattloom.operators import aggregates, filling
from wattloom.plans import central

START = datetime(2024, 3, 9, 22, 50)
RULES = {"a": (1, None), "b": (0, 2), "c": (0, 7), "d": (None, None), "e": (0, None), "f": (0, 0), "seeded": (1, None)}
RULE_SCHEMA = "variable_alias string, variable_name string, changepoint int, ffill_length int"


def raw_rows(seed: int, n: int = 160):
    """Rows of two sites: ``(site, ts, seq, variable, value)``, some moments with several variables, some minutes with many moments."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for site in ("s", "t"):
        t = START
        for reset in range(3):
            rows.append((site, datetime(2000, 1, 1) - timedelta(minutes=reset % 2), seq, rng.choice("abc"), float(rng.randint(1, 9))))
            seq += 1
        for _ in range(n):
            t += timedelta(minutes=rng.choice([0, 0, 0, 1, 1, 2, 7, 55, 130]))
            for variable in rng.sample("abcdef", rng.randint(1, 3)):
                rows.append((site, t, seq, variable, rng.choice([None, float(rng.randint(1, 9)), float(rng.randint(1, 9))])))
            rows.append((site, t, seq, "d", 1.0))  # a moment without any value would go
            seq += 1
    return rows


def wide_frame(rows, seeds):
    """The filled cells of every moment, by site and minute."""
    cells = defaultdict(dict)
    for site, t, seq, variable, value in rows:
        cells[site].setdefault((t, seq), defaultdict(list))[variable].append(value)
    out = defaultdict(lambda: defaultdict(list))
    for site, moments in cells.items():
        names = {v for m in moments.values() for v in m} | {v for s, v in seeds if s == site}
        for v in names:
            change, limit = RULES[v]
            last, age = None, 0
            for i, (t, seq) in enumerate(sorted(moments)):
                given = [x for x in moments[t, seq].get(v, []) if x is not None]
                value = sum(given) / len(given) if given else None
                if value is None and i == 0:
                    value = seeds.get((site, v))
                if value is not None:
                    last, age = value, 0
                else:
                    age += 1
                    if change == 1 or change == 0 and limit is not None and age <= limit:
                        value = last
                if t > datetime(2000, 1, 1):
                    out[site, v][t].append(value)
    return out


def mean(values):
    known = [x for x in values if x is not None]
    return sum(known) / len(known) if known else None


def near(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (v if v is None else pytest.approx(v)), (k, got[k], v)


@pytest.fixture(scope="module")
def book(spark):
    return spark.createDataFrame([(v, v, *rule) for v, rule in RULES.items()], RULE_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_fill_equals_the_wide_frame(spark, book, seed):
    rows = raw_rows(seed)
    seeds = {("s", "seeded"): 4.0, ("s", "a"): 8.0, ("s", "b"): 3.0, ("s", "d"): 2.0, ("elsewhere", "a"): 1.0} if seed == 2 else {}
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, seq int, variable string, value double")
    stored = spark.createDataFrame([(*k, v) for k, v in seeds.items()], "site string, variable string, value double") if seeds else None
    frame = wide_frame(rows, seeds)
    filled = filling.fill(df, book, seq="seq", seed=stored)
    want = {(s, v, t): mean(x) for (s, v), minutes in frame.items() for t, x in minutes.items()}
    near({(r["site"], r["variable"], r["ts"]): r["value"] for r in filling.minutes(filled).collect()}, want)
    sums = defaultdict(list)
    for (s, v, t), x in want.items():
        sums[s, v, t.replace(minute=0)].append(x)
    parts = {(r["site"], r["variable"], r["hour"]): (r["_sum"], r["_values"], r["_rows"]) for r in filling.hour_parts(filled, "mean").collect()}
    near(parts, {k: (pytest.approx(sum(y)) if (y := [i for i in x if i is not None]) else None, len(y), len(x)) for k, x in sums.items()})


def test_without_order_copies_of_a_moment_are_one(spark, book):
    rows = [("s", START, v, x) for v, x in (("a", 1.0), ("a", 3.0), ("b", None), ("b", 6.0))] + [("s", START + timedelta(minutes=1), "d", 9.0)]
    filled = filling.fill(spark.createDataFrame(rows, "site string, ts timestamp_ntz, variable string, value double"), book)
    assert sorted((r["variable"], r["ts"].minute, r["value"]) for r in filling.minutes(filled).collect()) == [
        ("a", 50, 2.0), ("a", 51, 2.0), ("b", 50, 6.0), ("b", 51, 6.0), ("d", 50, None), ("d", 51, 9.0)]


def test_nothing_gives_nothing(spark, book):
    none = spark.createDataFrame([], "site string, ts timestamp_ntz, seq int, variable string, value double")
    filled = filling.fill(none, book, seq="seq")
    assert filling.minutes(filled).count() == filling.hour_parts(filled).count() == 0


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "UTC"])
def test_plans_and_settled_tables_agree(spark, book, rows, zone):
    """Hours from pieces are those of the minutes; in the hour that the clock repeats, copies are averaged."""
    df = spark.createDataFrame(raw_rows(3), "site string, ts timestamp_ntz, seq int, variable string, value double")
    both = [central.transform(df, book, seq="seq", zone_from="UTC" if zone == "America/Los_Angeles" else zone, zone_to=zone,
                              hour_threshold=0.02, day_threshold=0.1, settle=settle) for settle in (True, False)]
    for a, b in zip(both[0][:3], both[1][:3], strict=True):
        got, want = ({(r["site"], r["variable"], r["ts"]): r["value"] for r in t.collect()} for t in (b, a))
        near(got, want)
    kept = aggregates.hour_parts(both[0].minute)
    assert {r["_rows"] for r in kept.collect()} != {1}

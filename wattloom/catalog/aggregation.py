"""Aggregation, completeness, load-shift and join queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import EVENT_TYPES, grain_readings, grain_sql, readings, readings_sql, rounded, table
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE, complete_rows, literal_table, to_wide
from wattloom.operators import aggregates, cleaning, intervals, joins
from wattloom.plans import central

# click counts as energy here, so both the summed and the averaged half are exercised
NAMES = {"click": "EnergyIn_HPWH", "view": "EnergyRate_HPWH"}
NAMED = "CASE variable WHEN 'click' THEN 'EnergyIn_HPWH' WHEN 'view' THEN 'EnergyRate_HPWH' ELSE variable END"


def _named(df):
    name = F.when(F.col(VARIABLE) == "click", NAMES["click"]).when(F.col(VARIABLE) == "view", NAMES["view"])
    return df.withColumn(VARIABLE, F.coalesce(name, F.col(VARIABLE)))


def _minutes(spark, sf, sites=2):
    """Clean minute rows with a row per variable and moment."""
    df = cleaning.average_duplicates(cleaning.floor_to(_named(readings(spark, sf, sites))))
    return complete_rows(df)


MINUTES = f"""
    WITH m AS (SELECT site, date_trunc('minute', ts) AS ts, {NAMED} AS variable, avg(value) AS value
               FROM ({readings_sql(2)}) GROUP BY 1, 2, 3),
    full_rows AS (SELECT a.site, a.ts, b.variable, m.value
               FROM (SELECT DISTINCT site, ts FROM m) a JOIN (SELECT DISTINCT site, variable FROM m) b ON a.site = b.site
               LEFT JOIN m ON m.site = a.site AND m.ts = a.ts AND m.variable = b.variable),
    hours AS (SELECT site, variable, date_trunc('hour', ts) AS ts, sum(value) AS s, count(value) AS n, count(*) AS rows
              FROM full_rows WHERE variable <> 'EnergyRate_HPWH' GROUP BY 1, 2, 3),
    kept AS (SELECT *, CASE WHEN variable = 'EnergyIn_HPWH' THEN coalesce(s, 0) ELSE s / n END AS v FROM hours)"""


@query("hour_day_aggregate", f"""{MINUTES}
    SELECT 'HOUR' AS grain, site, variable, ts, round(v, 7) AS value FROM kept
    UNION ALL
    SELECT 'DAY', site, variable, date_trunc('day', ts),
           round(CASE WHEN variable = 'EnergyIn_HPWH' THEN coalesce(sum(s), 0) ELSE sum(s) / sum(n) END, 7)
    FROM hours GROUP BY site, variable, date_trunc('day', ts)""")
def hour_day_aggregate(spark, sf):
    both = aggregates.both_grains(aggregates.hour_parts(_minutes(spark, sf)), remove_partial=False)
    return both.withColumn(VALUE, rounded(VALUE, 7))


@query("dense_hourly_grid", f"""
    WITH h AS (SELECT site, {NAMED} AS variable, date_trunc('hour', ts) AS ts, sum(value) AS s, avg(value) AS a
               FROM ({readings_sql()}) WHERE variable <> 'view' GROUP BY 1, 2, 3),
    span AS (SELECT site, min(ts) AS lo, max(ts) AS hi FROM h GROUP BY 1),
    grid AS (SELECT v.site, v.variable, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
             FROM (SELECT DISTINCT site, variable FROM h) v JOIN span ON v.site = span.site)
    SELECT g.site, g.variable, g.ts,
           round(CASE WHEN g.variable = 'EnergyIn_HPWH' THEN coalesce(s, 0) ELSE a END, 6) AS value
    FROM grid g LEFT JOIN h ON g.site = h.site AND g.variable = h.variable AND g.ts = h.ts""")
def dense_hourly_grid(spark, sf):
    out = aggregates.aggregate(_named(readings(spark, sf)), "HOUR", dense=True)
    return out.withColumn(VALUE, rounded(VALUE))


@query("completeness_hour", f"""{MINUTES}
    SELECT site, variable, ts, round(CASE WHEN n >= 1.2 THEN v END, 6) AS value FROM kept WHERE rows >= 1.2""")
def completeness_hour(spark, sf):
    hours, _ = aggregates.hour_and_day(_minutes(spark, sf), hour_threshold=0.02)
    return hours.withColumn(VALUE, rounded(VALUE))


@query("completeness_day", f"""{MINUTES},
    days AS (SELECT site, variable, date_trunc('day', ts) AS ts, sum(s) AS s, sum(n) AS n,
                    count(*) FILTER (WHERE rows >= 1.2) AS hours,
                    count(*) FILTER (WHERE rows >= 1.2 AND n >= 1.2) AS filled FROM kept GROUP BY 1, 2, 3)
    SELECT site, variable, ts, round(CASE WHEN filled >= 9.6 THEN
           CASE WHEN variable = 'EnergyIn_HPWH' THEN coalesce(s, 0) ELSE s / n END END, 7) AS value
    FROM days WHERE hours >= 9.6""")
def completeness_day(spark, sf):
    _, days = aggregates.hour_and_day(_minutes(spark, sf), hour_threshold=0.02, day_threshold=0.4)
    return days.withColumn(VALUE, rounded(VALUE, 7))


@query("summary_means", f"""
    SELECT site, variable, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value FROM ({readings_sql()})
    GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def summary_means(spark, sf):
    hours = aggregates.complete_hours(aggregates.hour_parts(readings(spark, sf), mean_only=True), 0.05, mean_only=True)
    return hours.withColumn(VALUE, rounded(VALUE))


@query("gap_statistics", f"""
    WITH m AS (SELECT site, variable, ts, CASE WHEN value <= 60 THEN value END AS value FROM ({grain_sql(sites=2)})),
    span AS (SELECT site, date_trunc('day', min(ts)) + CASE WHEN min(ts) = date_trunc('day', min(ts))
                    THEN INTERVAL 0 DAY ELSE INTERVAL 1 DAY END AS a,
                    date_trunc('day', max(ts)) - INTERVAL 1 DAY AS b FROM m GROUP BY 1),
    days AS (SELECT v.site, v.variable, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day
             FROM (SELECT DISTINCT site, variable FROM m) v JOIN span ON v.site = span.site),
    grid AS (SELECT site, variable, day, unnest(generate_series(day, day + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS ts FROM days),
    f AS (SELECT g.*, m.value IS NULL AS gap FROM grid g LEFT JOIN m
          ON g.site = m.site AND g.variable = m.variable AND g.ts = m.ts),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, variable, day ORDER BY ts)
                  - row_number() OVER (PARTITION BY site, variable, day, gap ORDER BY ts) AS isl FROM f),
    g AS (SELECT site, variable, day, count(*) AS len FROM i WHERE gap GROUP BY site, variable, day, isl)
    SELECT d.site, d.variable, d.day, CAST(coalesce(sum(len), 0) AS BIGINT) AS missing_slots,
           round(coalesce(avg(len), 0), 6) AS avg_gap, coalesce(max(len), 0) AS max_gap
    FROM days d LEFT JOIN g ON d.site = g.site AND d.variable = g.variable AND d.day = g.day GROUP BY 1, 2, 3""")
def gap_statistics(spark, sf):
    df = grain_readings(spark, sf, sites=2).withColumn(VALUE, F.when(F.col(VALUE) <= 60, F.col(VALUE)))
    return aggregates.gap_statistics(df, "HOUR").withColumn("avg_gap", rounded("avg_gap"))


def schedule(spark, sf):
    """Load-shift windows of 1 to 30 hours derived from orders, mapped into January 2024."""
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.pmod("o_orderkey", F.lit(29)).cast("int"), F.pmod("o_custkey", F.lit(24)).cast("int"))
    hours = (F.pmod("o_orderkey", F.lit(30)) + 1).cast("int")
    event = F.when(F.col("o_orderstatus") == "O", "loadUp").when(F.col("o_orderstatus") == "F", "shed").otherwise("criticalPeak")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("site_"), F.pmod("o_custkey", F.lit(10)).cast("string")).alias(SITE), event.alias("event"),
        start.alias("start"), (start + F.make_dt_interval(F.lit(0), hours)).alias("end"), F.col("o_orderkey").alias("seq"))


SCHEDULE = """sched AS (SELECT 'site_' || CAST(o_custkey % 10 AS VARCHAR) AS site,
        CASE o_orderstatus WHEN 'O' THEN 'loadUp' WHEN 'F' THEN 'shed' ELSE 'criticalPeak' END AS event,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 29 AS INT)) + to_hours(o_custkey % 24) AS start,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 29 AS INT)) + to_hours(o_custkey % 24)
            + to_hours(o_orderkey % 30 + 1) AS stop, o_orderkey AS seq
    FROM orders)"""


@query("load_shift_state", f"""
    WITH {SCHEDULE}, h AS (SELECT DISTINCT site, ts FROM ({grain_sql()})),
    hit AS (SELECT h.site, h.ts, arg_max(event, seq) AS event FROM h JOIN sched s
            ON h.site = s.site AND h.ts >= s.start AND h.ts < s.stop GROUP BY 1, 2)
    SELECT h.site, h.ts, coalesce(event, 'normal') AS system_state FROM h LEFT JOIN hit ON h.site = hit.site AND h.ts = hit.ts""")
def load_shift_state(spark, sf):
    hours = grain_readings(spark, sf).select(SITE, TS).distinct()
    return aggregates.load_shift_state(hours, schedule(spark, sf))


@query("load_shift_day", f"""
    WITH {SCHEDULE}, d AS (SELECT DISTINCT site, date_trunc('day', ts) AS ts FROM ({readings_sql()}))
    SELECT d.site, d.ts, EXISTS (SELECT 1 FROM sched s WHERE s.site = d.site
        AND (CAST(s.start AS DATE) = CAST(d.ts AS DATE) OR CAST(s.stop AS DATE) = CAST(d.ts AS DATE))) AS load_shift_day FROM d""")
def load_shift_day(spark, sf):
    days = readings(spark, sf).select(SITE, floor_time(F.col(TS), "DAY").alias(TS)).distinct()
    return aggregates.load_shift_days(days, schedule(spark, sf))


@query("inside_windows", f"""
    WITH {SCHEDULE} SELECT r.site, r.ts, r.variable, r.value, s.event, s.seq FROM ({readings_sql()}) r JOIN sched s
    ON r.site = s.site AND r.ts >= s.start AND r.ts < s.stop""")
def inside_windows(spark, sf):
    return intervals.inside(readings(spark, sf), schedule(spark, sf)).select(SITE, TS, VARIABLE, VALUE, "event", "seq")


@query("outside_windows", f"""
    WITH {SCHEDULE} SELECT r.* FROM ({readings_sql()}) r WHERE NOT EXISTS (SELECT 1 FROM sched s
    WHERE r.site = s.site AND r.ts >= s.start AND r.ts < s.stop)""")
def outside_windows(spark, sf):
    return intervals.inside(readings(spark, sf), schedule(spark, sf), "left_anti")


SIGNAL = f"""SELECT site, ts, 1 + floor(value / 40) AS ls FROM ({readings_sql()}) WHERE variable = 'click'"""
SIGNAL_HOURS = f"""SELECT site, date_trunc('hour', ts) AS ts,
    CASE round_even(avg(ls), 0) WHEN 1 THEN 'normal' WHEN 2 THEN 'loadUp' WHEN 3 THEN 'shed' END AS system_state
    FROM ({SIGNAL}) GROUP BY 1, 2"""


def _signal(spark, sf):
    df = readings(spark, sf).where(F.col(VARIABLE) == "click").select(
        SITE, TS, F.lit("ls").alias(VARIABLE), (1 + F.floor(F.col(VALUE) / 40)).cast("double").alias(VALUE))
    return aggregates.signal_state(df, "ls", {1: "normal", 2: "loadUp", 3: "shed"})


@query("signal_state", SIGNAL_HOURS)
def signal_state(spark, sf):
    return _signal(spark, sf)[0]


@query("signal_day", f"""SELECT site, date_trunc('day', ts) AS ts,
    coalesce(bool_or(system_state <> 'normal'), FALSE) AS load_shift_day FROM ({SIGNAL_HOURS}) GROUP BY 1, 2""")
def signal_day(spark, sf):
    return _signal(spark, sf)[1]


WIDE = ("SELECT site, ts, " + ", ".join(f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in EVENT_TYPES)
        + f" FROM ({grain_sql()}) GROUP BY 1, 2")


def _weather(spark, sf):
    return grain_readings(spark, sf).where(F.col(VARIABLE) == "view").select(SITE, TS, F.col(VALUE).alias("OAT_NOAA"))


WEATHER = f"(SELECT site, ts, value AS OAT_NOAA FROM ({grain_sql()}) WHERE variable = 'view')"
HOURS = f"(SELECT site, ts, value AS load FROM ({grain_sql()}) WHERE variable = 'click')"


@query("weather_left_join", f"""
    SELECT h.site, h.ts, round(load, 6) AS load, round(OAT_NOAA, 6) AS OAT_NOAA
    FROM {HOURS} h LEFT JOIN {WEATHER} w ON h.site = w.site AND h.ts = w.ts""")
def weather_left_join(spark, sf):
    hours = grain_readings(spark, sf).where(F.col(VARIABLE) == "click").select(SITE, TS, F.col(VALUE).alias("load"))
    out = joins.join_weather(hours, _weather(spark, sf))
    return out.select(SITE, TS, rounded("load").alias("load"), rounded("OAT_NOAA").alias("OAT_NOAA"))


@query("daily_oat", f"""
    SELECT h.site, date_trunc('day', h.ts) AS ts, round(avg(OAT_NOAA), 6) AS OAT_NOAA
    FROM {HOURS} h LEFT JOIN {WEATHER} w ON h.site = w.site AND h.ts = w.ts GROUP BY 1, 2""")
def daily_oat(spark, sf):
    hours = grain_readings(spark, sf).where(F.col(VARIABLE) == "click").select(SITE, TS, F.col(VALUE).alias("load"))
    out = joins.daily_weather(joins.join_weather(hours, _weather(spark, sf)), "OAT_NOAA")
    return out.withColumn("OAT_NOAA", rounded("OAT_NOAA"))


@query("daily_cop_join", """
    WITH d AS (SELECT l_shipdate AS ts, sum(l_quantity) AS heat FROM lineitem GROUP BY 1),
    c AS (SELECT o_orderdate AS ts, count(*) AS cop FROM orders GROUP BY 1)
    SELECT 'plant' AS site, d.ts, heat, cop FROM d LEFT JOIN c ON d.ts = c.ts""")
def daily_cop_join(spark, sf):
    days = table(spark, sf, "lineitem").groupBy(F.lit("plant").alias(SITE), F.col("l_shipdate").alias(TS)).agg(
        F.sum("l_quantity").alias("heat"))
    cop = table(spark, sf, "orders").groupBy(F.lit("plant").alias(SITE), F.col("o_orderdate").alias(TS)).agg(
        F.count(F.lit(1)).alias("cop"))
    return joins.join_daily(days, cop)


@query("rolling_blocks", """
    WITH d AS (SELECT l_returnflag AS site, l_shipdate AS ts, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT site, ts, qty FROM (SELECT site, ts, sum(qty) OVER w AS qty, count(*) OVER w AS n FROM d
        WINDOW w AS (PARTITION BY site ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) WHERE n = 7""")
def rolling_blocks(spark, sf):
    days = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias(SITE), F.col("l_shipdate").alias(TS)).agg(
        F.sum("l_quantity").alias("qty"))
    return aggregates.rolling_blocks(days, ["qty"], 7)


@query("rename_wide", f"""
    SELECT site, ts, round(click, 6) AS Temp_Supply, round(view, 6) AS Temp_Return FROM ({WIDE}) WHERE click IS NOT NULL OR view IS NOT NULL""")
def rename_wide(spark, sf):
    wide = to_wide(grain_readings(spark, sf), EVENT_TYPES)
    out = cleaning.rename_wide(wide, {"click": "Temp_Supply", "view": "Temp_Return", "gone": "Temp_X"})
    return out.select(SITE, TS, rounded("Temp_Supply").alias("Temp_Supply"), rounded("Temp_Return").alias("Temp_Return"))


@query("unseen_files", """
    SELECT DISTINCT source AS file FROM documents WHERE source NOT IN (
        SELECT source FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY source HAVING count(*) > 20)""")
def unseen_files(spark, sf):
    docs = table(spark, sf, "documents")
    listed = docs.select(F.col("source").alias("file")).distinct()
    registry = docs.join(table(spark, sf, "labels"), "doc_id").groupBy(F.col("source").alias("file")).count().where("count > 20")
    return joins.unseen(listed, registry)


RULE_SCHEMA = "variable_alias string, variable_name string, lower_bound double, upper_bound double, changepoint int, ffill_length int"
FLAGSHIP_RULES = [(v, v, 1.0, 300.0, 0, 2) for v in EVENT_TYPES]
# without limit, for two rows, or not at all
MIXED_RULES = [(v, v, 1.0, 300.0, *fill) for v, fill in zip(
    EVENT_TYPES, ((1, None), (0, 2), (None, None), (1, None), (0, 1)), strict=True)]


def transform_sql(site: str, limits: dict[str, str], minutes: bool) -> str:
    """The transform from raw rows: a place for each variable in each row, fill, minutes, hours and days."""
    filled = " ".join(f"WHEN '{v}' THEN last_value(v IGNORE NULLS) OVER (PARTITION BY site, variable ORDER BY m, event_id "
                      f"ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)" for v, n in limits.items())
    minute = "UNION ALL SELECT 'MINUTE', site, variable, ts, round(value, 6) FROM mm" if minutes else ""
    return f"""
    WITH r AS (SELECT {site} AS site, ts, event_id, event_type, CASE WHEN value BETWEEN 1 AND 300 THEN value END AS v FROM events),
    k AS (SELECT *, count(v) OVER (PARTITION BY site, ts) AS n FROM r),
    t AS (SELECT DISTINCT site, event_type AS variable FROM k WHERE n > 0),
    g AS (SELECT k.site, date_trunc('minute', ts) AS m, event_id, variable, CASE WHEN event_type = variable THEN v END AS v
          FROM k JOIN t ON k.site = t.site WHERE n > 0),
    f AS (SELECT site, m, variable, coalesce(v, CASE variable {filled} END) AS v FROM g),
    mm AS (SELECT site, m AS ts, variable, avg(v) AS value FROM f GROUP BY 1, 2, 3),
    h AS (SELECT site, variable, date_trunc('hour', ts) AS hour, sum(value) AS s, count(value) AS n, count(*) AS r
          FROM mm GROUP BY 1, 2, 3),
    d AS (SELECT site, variable, date_trunc('day', hour) AS day, sum(s) AS s, sum(n) AS n,
          count(*) FILTER (WHERE r >= 1.2 AND n >= 1.2) AS ok, count(*) FILTER (WHERE r >= 1.2) AS hours FROM h GROUP BY 1, 2, 3)
    SELECT 'HOUR' AS grain, site, variable, hour AS ts, round(CASE WHEN n >= 1.2 THEN s / n END, 6) AS value FROM h WHERE r >= 1.2
    UNION ALL
    SELECT 'DAY', site, variable, day, round(CASE WHEN ok >= 12 THEN s / n END, 6) FROM d WHERE hours >= 12 {minute}"""


def _transformed(spark, sf, site, rules) -> central.Tables:
    raw = table(spark, sf, "events").select(site.alias(SITE), TS, F.col("event_type").alias(VARIABLE), VALUE, "event_id")
    rules = literal_table(spark, rules, RULE_SCHEMA)
    return central.transform(cleaning.outliers_to_null(raw, rules), rules, seq="event_id", hour_threshold=0.02, day_threshold=0.5, settle=False)


def _grains(**tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        t.select(F.lit(name.upper()).alias("grain"), SITE, VARIABLE, TS, rounded(VALUE).alias(VALUE)) for name, t in tables.items()])


@query("minute_to_day", transform_sql("'plant'", dict.fromkeys(EVENT_TYPES, "2"), False))
def minute_to_day(spark, sf):
    """Bounds, floor, fill, average duplicates, then complete hours and days: the main transform."""
    out = _transformed(spark, sf, F.lit("plant"), FLAGSHIP_RULES)
    return _grains(hour=out.hour, day=out.day)


@query("transform_day", transform_sql(
    "'site_' || user_id % 10", {"click": "UNBOUNDED", "error": "2", "signup": "UNBOUNDED", "view": "1"}, True))
def transform_day(spark, sf):
    """The main transform of sites with sparse devices and a fill rule of each kind."""
    out = _transformed(spark, sf, F.concat(F.lit("site_"), F.pmod("user_id", F.lit(10)).cast("string")), MIXED_RULES)
    return _grains(minute=out.minute, hour=out.hour, day=out.day)


@query("completeness_exclusion", f"""
    WITH g AS (SELECT * FROM ({grain_sql('minute', 2)})), v AS (SELECT DISTINCT site, variable FROM g), m AS (SELECT DISTINCT site, ts FROM g),
    w AS (SELECT m.site, m.ts, v.variable, g.value FROM m JOIN v ON m.site = v.site
          LEFT JOIN g ON g.site = m.site AND g.ts = m.ts AND g.variable = v.variable),
    h AS (SELECT site, variable, date_trunc('hour', ts) AS ts, avg(value) AS value, count(value) AS n, count(*) AS r FROM w GROUP BY 1, 2, 3)
    SELECT site, variable, ts, round(CASE WHEN n >= 3 OR variable = 'view' THEN value END, 6) AS value FROM h WHERE r >= 3""")
def completeness_exclusion(spark, sf):
    """A variable that is exempt keeps its hourly value however few minutes it has."""
    parts = aggregates.hour_parts(complete_rows(grain_readings(spark, sf, "MINUTE", 2)))
    return aggregates.complete_hours(parts, 0.05, exclude=["view"]).withColumn(VALUE, rounded(VALUE))


@query("long_to_wide", WIDE)
def long_to_wide(spark, sf):
    return to_wide(grain_readings(spark, sf), EVENT_TYPES)

"""Ordered-series queries: streaks, runs, transitions, event numbers."""

from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import grain_readings, grain_sql, readings, readings_sql, rounded
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.operators import sequences
from wattloom.operators.aggregates import first_outage_per_day
from wattloom.operators.intervals import first_per_key, latest

DAY_KEYS = [SITE, VARIABLE, "day"]

# Runs of equal mask within a day, in SQL: `isl` names the run, `nth` the place in it.
ISLANDS = f"""
    SELECT *, row_number() OVER (PARTITION BY site, variable, day, mask, isl ORDER BY ts) AS nth FROM (
        SELECT *, row_number() OVER (PARTITION BY site, variable, day ORDER BY ts)
                - row_number() OVER (PARTITION BY site, variable, day, mask ORDER BY ts) AS isl
        FROM (SELECT site, variable, ts, value, date_trunc('day', ts) AS day, value > 40 AS mask FROM ({grain_sql()})))"""


def _masked(spark, sf):
    return grain_readings(spark, sf).select(
        SITE, VARIABLE, TS, VALUE, floor_time(F.col(TS), "DAY").alias("day"), (F.col(VALUE) > 40).alias("mask"))


@query("streaks", f"""
    SELECT site, variable, day, min(ts) FILTER (WHERE nth = 2) - INTERVAL 1 HOUR AS start, max(ts) AS "end",
           CAST(count(*) AS INTEGER) AS length
    FROM ({ISLANDS}) WHERE mask GROUP BY site, variable, day, isl HAVING count(*) >= 2""")
def streaks(spark, sf):
    return sequences.streaks(_masked(spark, sf), "mask", 2, DAY_KEYS, grain="HOUR")


@query("streaks_across_days", f"""
    WITH m AS (SELECT site, variable, ts, value > 20 AS mask FROM ({grain_sql(sites=2)})),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, variable ORDER BY ts)
                  - row_number() OVER (PARTITION BY site, variable, mask ORDER BY ts) AS isl FROM m),
    n AS (SELECT *, row_number() OVER (PARTITION BY site, variable, mask, isl ORDER BY ts) AS nth FROM i)
    SELECT site, variable, min(ts) FILTER (WHERE nth = 5) - INTERVAL 4 HOUR AS start, max(ts) AS "end",
           CAST(count(*) AS INTEGER) AS length
    FROM n WHERE mask GROUP BY site, variable, isl HAVING count(*) >= 5""")
def streaks_across_days(spark, sf):
    df = grain_readings(spark, sf, sites=2).withColumn("mask", F.col(VALUE) > 20)
    return sequences.streaks(df, "mask", 5, [SITE, VARIABLE], grain="HOUR", segment=sequences.day_segment())


@query("warmup_streaks", f"""
    WITH n AS (SELECT site, variable, day, ts, mask AND nth > 1 AS late FROM ({ISLANDS})),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, variable, day ORDER BY ts)
                  - row_number() OVER (PARTITION BY site, variable, day, late ORDER BY ts) AS isl FROM n)
    SELECT site, variable, day, min(ts) AS start, max(ts) AS "end", CAST(count(*) AS INTEGER) AS length
    FROM i WHERE late GROUP BY site, variable, day, isl""")
def warmup_streaks(spark, sf):
    settled = sequences.past_warmup(_masked(spark, sf), "mask", 1, DAY_KEYS)
    return sequences.streaks(settled, "settled", 1, DAY_KEYS, grain="HOUR")


@query("short_runs", f"""
    WITH m AS (SELECT site, variable, ts, value > 40 AS mask FROM ({grain_sql()})),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, variable ORDER BY ts)
                  - row_number() OVER (PARTITION BY site, variable, mask ORDER BY ts) AS isl,
                 min(ts) OVER (PARTITION BY site, variable) AS lo, max(ts) OVER (PARTITION BY site, variable) AS hi FROM m)
    SELECT site, variable, min(ts) AS start, max(ts) AS "end", CAST(count(*) AS INTEGER) AS length
    FROM i WHERE mask GROUP BY site, variable, isl, lo, hi
    HAVING count(*) < 3 AND min(ts) <> lo AND max(ts) <> hi""")
def short_runs(spark, sf):
    return sequences.short_runs(
        _masked(spark, sf), "mask", 3, [SITE, VARIABLE], segment=sequences.day_segment())


@query("transitions", f"""
    SELECT site, variable, ts, value > 40 AND prev <= 40 AS turned_on, value <= 40 AND prev > 40 AS turned_off
    FROM (SELECT *, lag(value) OVER (PARTITION BY site, variable, date_trunc('day', ts) ORDER BY ts) AS prev
          FROM ({grain_sql()})) WHERE (value > 40) <> (prev > 40)""")
def transitions(spark, sf):
    out = sequences.transitions(_masked(spark, sf), F.col(VALUE) > 40, F.col(VALUE) <= 40, DAY_KEYS)
    return out.where("turned_on OR turned_off").select(SITE, VARIABLE, TS, "turned_on", "turned_off")


MINUTES_SQL = """SELECT 'site_' || CAST(user_id % 10 AS VARCHAR) AS site, date_trunc('minute', ts) AS ts,
    avg(value) AS value FROM events GROUP BY 1, 2"""


def _site_minutes(spark, sf):
    return readings(spark, sf).groupBy(SITE, floor_time(F.col(TS), "MINUTE").alias(TS)).agg(F.avg(VALUE).alias(VALUE))


@query("event_ids", f"""
    WITH r AS (SELECT *, value > 45 AS is_on, row_number() OVER w AS rn, lag(ts) OVER w AS before,
                      lag(value > 45) OVER w AS was_on FROM ({MINUTES_SQL}) WINDOW w AS (PARTITION BY site ORDER BY ts)),
    i AS (SELECT *, CASE WHEN rn = 1 THEN 0 WHEN is_on THEN CAST(ts - before > INTERVAL 10 MINUTE AS INT)
                         ELSE CAST(rn > 2 OR was_on AS INT) END AS rise FROM r)
    SELECT site, ts, CAST(CASE WHEN rn = 1 THEN CAST(is_on AS INT)
        ELSE 1 + sum(rise) OVER (PARTITION BY site ORDER BY ts) END AS BIGINT) AS event_id FROM i""")
def event_ids(spark, sf):
    out = sequences.event_ids(_site_minutes(spark, sf), F.col(VALUE) > 45, segment=sequences.day_segment())
    return out.select(SITE, TS, "event_id")


@query("event_runs", f"""
    WITH r AS (SELECT *, value > 45 AS is_on FROM ({MINUTES_SQL})),
    c AS (SELECT *, lag(is_on) OVER (PARTITION BY site ORDER BY ts) AS was_on FROM r)
    SELECT site, ts, CAST(sum(CASE WHEN was_on IS NULL OR was_on <> is_on THEN 1 ELSE 0 END)
        OVER (PARTITION BY site ORDER BY ts) AS BIGINT) AS event_id FROM c""")
def event_runs(spark, sf):
    out = sequences.event_ids(
        _site_minutes(spark, sf), F.col(VALUE) > 45, segment=sequences.day_segment(), mode="runs")
    return out.select(SITE, TS, "event_id")


@query("first_outage_per_day", f"""
    WITH m AS (SELECT site, ts, date_trunc('day', ts) AS day, value < 60 AS mask
               FROM ({grain_sql(sites=2)}) WHERE variable = 'view'),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, day ORDER BY ts)
                  - row_number() OVER (PARTITION BY site, day, mask ORDER BY ts) AS isl FROM m),
    n AS (SELECT *, row_number() OVER (PARTITION BY site, day, mask, isl ORDER BY ts) AS nth FROM i),
    f AS (SELECT site, day, min(ts) - INTERVAL 3 MINUTE AS t FROM n WHERE mask AND nth = 4 GROUP BY 1, 2)
    SELECT site, day AS start_time_pt, day + INTERVAL 1 DAY - INTERVAL 1 MINUTE AS end_time_pt, 'ALARM' AS event_type,
           'Hot Water Outage Occured (first one starting at ' || strftime(t, '%H:%M') || ')' AS event_detail FROM f""")
def outage(spark, sf):
    return first_outage_per_day(grain_readings(spark, sf, sites=2), "view", 60, 4)


@query("latest_row", f"""
    SELECT site, arg_max(ts, (ts, value, variable)) AS ts, arg_max(variable, (ts, value, variable)) AS variable,
           arg_max(value, (ts, value, variable)) AS value FROM ({readings_sql()}) GROUP BY site""")
def latest_row(spark, sf):
    return latest(readings(spark, sf).select(SITE, TS, VALUE, VARIABLE), [SITE])


@query("first_row_per_key", """
    SELECT o_custkey AS custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
           min(o_orderdate) AS o_orderdate FROM orders GROUP BY 1""")
def first_row_per_key(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderdate")
    return first_per_key(df, ["custkey"], ["o_orderdate", "o_orderkey"])


@query("next_minus_current", f"""
    SELECT site, variable, ts, round(lead(value) OVER (PARTITION BY site, variable ORDER BY ts) - value, 6) AS step
    FROM ({grain_sql()})""")
def next_minus_current(spark, sf):
    seen = sequences.ordered(
        grain_readings(spark, sf), [SITE, VARIABLE], [TS], sequences.day_segment(), lead={"_next": F.col(VALUE)})
    return seen.select(SITE, VARIABLE, TS, rounded(F.col("_next") - F.col(VALUE)).alias("step"))

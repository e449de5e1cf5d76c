"""Queries that go through files, stores and streams: inputs are written from the given tables and read back by the library."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wattloom.catalog.aggregation import _grains
from wattloom.catalog.landing import BOTH
from wattloom.catalog.registry import query
from wattloom.catalog.storage import DETAIL, KEPT_BY, KINDS, SESSIONS, _alarms
from wattloom.catalog.tables import EVENT_TYPES, readings, readings_sql, rounded, table
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.operators import cleaning
from wattloom.session import settled_from
from wattloom.sinks import alarm_store, events as site_events, upsert
from wattloom.sources import dispatch, files, tables, weather
from wattloom.streaming import incremental

SHOWN = "yyyy-MM-dd HH:mm:ss"


def _wide_lines(spark, sf) -> DataFrame:
    """A row per event, with its value under its type."""
    return table(spark, sf, "events").select(
        F.date_format(TS, "yyyy/MM/dd HH:mm:ss").alias("DateTime"),
        *[F.when(F.col("event_type") == n, F.col(VALUE)).alias(n) for n in EVENT_TYPES])


@query("raw_files", f"SELECT 'lab' AS site, sec AS ts, name AS variable, v AS value FROM ({BOTH})")
def raw_files(spark, sf):
    """Logger files of a folder by suffix and prefix; an empty file and files of other kinds lie beside them."""
    def make(folder):
        lines = _wide_lines(spark, sf)
        lines.repartition(4).write.option("header", "true").csv(folder)
        lines.where("false").coalesce(1).write.mode("append").option("header", "true").csv(folder)
        lines.limit(5).coalesce(1).write.mode("append").json(folder)
        return dispatch.read_raw(spark, "csv", folder, "lab", prefix="part-")

    return settled_from(spark, "files", make)


@query("file_listing", """SELECT 'part' AS name, CAST(1 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS lines FROM nation""")
def file_listing(spark, sf):
    def make(folder):
        table(spark, sf, "nation").select("n_name").coalesce(1).write.text(folder + "/below")
        listed = files.list_files(spark, folder, suffix=".txt", prefix="part-", recursive=True).where("length > 0")
        lines = files.read_lines(spark, folder, suffix=".txt", recursive=True).groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"))
        return listed.join(lines, "file_name").groupBy(F.substring("file_name", 1, 4).alias("name")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines"))

    return settled_from(spark, "listing", make)


@query("forecast_hours", """
    SELECT 'K' || user_id % 7 AS station, timezone('America/Denver', timezone('UTC', ts)) AS ts,
           CAST(CAST(value AS FLOAT) AS DOUBLE) AS "airTemp_F", CAST(NULL AS DOUBLE) AS "dewPoint_F" FROM events""")
def forecast_hours(spark, sf):
    landed = table(spark, sf, "events").select(
        F.concat(F.lit("K"), F.pmod("user_id", F.lit(7)).cast("string")).alias("station"), TS, F.col(VALUE).cast("float").alias("temperature_2m"))
    return weather.forecast_hours(landed, "America/Denver")


@query("event_log_file", f"""
    SELECT 'lab' AS site, CAST(o_orderdate AS TIMESTAMP) AS start_time_pt, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY END
           AS end_time_pt, {KINDS} AS event_type, {DETAIL} AS event_detail FROM orders""")
def event_log_file(spark, sf):
    def make(folder):
        start = F.col("o_orderdate").cast("timestamp_ntz")
        table(spark, sf, "orders").select(
            F.date_format(start, SHOWN).alias("start_time_pt"),
            F.when(F.col("o_orderkey") % 3 > 0, F.date_format(start + F.expr("INTERVAL '1' DAY"), "yyyy/MM/dd HH:mm:ss")).alias("end_time_pt"),
            F.expr(KINDS).alias("event_type"), F.expr(DETAIL).alias("event_detail")).write.option("header", "true").csv(folder)
        log = tables.read_event_log(spark, folder, "lab")
        return log.unionByName(tables.read_event_log(spark, folder + "/none", "lab"))

    return settled_from(spark, "log", make)


@query("schedule_file", """
    SELECT 'lab' AS site, o_orderstatus AS event, CAST(o_orderdate AS TIMESTAMP) + to_hours(o_custkey % 12) AS start,
           CAST(o_orderdate AS TIMESTAMP) + to_hours(o_custkey % 12 + 3) + INTERVAL 30 MINUTE AS "end" FROM orders""")
def schedule_file(spark, sf):
    def make(folder):
        hour = F.pmod("o_custkey", F.lit(12)).cast("int")
        table(spark, sf, "orders").select(
            F.date_format("o_orderdate", "M/d/yyyy").alias("date"), F.format_string("%02d:00", hour).alias("startTime"),
            F.format_string("%02d:30", hour + 3).alias("endTime"), F.col("o_orderstatus").alias("event")).write.option("header", "true").csv(folder)
        return tables.read_schedule(spark, folder, "lab").drop("seq")

    return settled_from(spark, "schedule", make)


@query("site_file", "SELECT n_name AS site, CAST(n_regionkey AS VARCHAR) AS zone FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_20')")
def site_file(spark, sf):
    """The line after the header is a comment."""
    def make(folder):
        rows = table(spark, sf, "nation").select(F.col("n_name").alias("site"), F.col("n_regionkey").cast("string").alias("zone"), F.lit(1).alias("o"))
        first = spark.range(1).select(F.lit("NATION_1").alias("site"), F.lit("a comment").alias("zone"), F.lit(0).alias("o"))
        rows.unionByName(first).coalesce(1).sortWithinPartitions("o").drop("o").write.option("header", "true").csv(folder)
        found = [tables.read_site_table(spark, folder, s) for s in ("NATION_1", "NATION_7", "NATION_20", "none")]
        return reduce(DataFrame.unionByName, found)

    return settled_from(spark, "sites", make)


@query("stored_run", f"""
    WITH r AS ({readings_sql()}), m AS (SELECT site, variable, date_trunc('minute', ts) AS ts, avg(value) AS value FROM r GROUP BY ALL),
    h AS (SELECT site, variable, date_trunc('hour', ts) AS ts, avg(value) AS value FROM m GROUP BY ALL),
    d AS (SELECT site, variable, date_trunc('day', ts) AS ts, avg(value) AS value FROM m GROUP BY ALL)
    SELECT 'MINUTE' AS grain, site, variable, ts, round(value, 6) AS value FROM m UNION ALL SELECT 'HOUR', site, variable, ts, round(value, 6) FROM h
    UNION ALL SELECT 'DAY', site, variable, ts, round(value, 6) FROM d
    UNION ALL SELECT 'STATS', site, variable, ts, CAST(count(*) AS DOUBLE) FROM (SELECT site, variable, date_trunc('day', ts) AS ts FROM m) GROUP BY ALL""")
def stored_run(spark, sf):
    """Minutes, hours, days and statistics of two loads; the second one repeats the first, corrected."""
    def make(folder):
        minute = cleaning.average_duplicates(cleaning.floor_to(readings(spark, sf)))
        grain = lambda g: minute.groupBy(SITE, VARIABLE, floor_time(F.col(TS), g).alias(TS)).agg(F.avg(VALUE).alias(VALUE))
        days = minute.groupBy(SITE, VARIABLE, floor_time(F.col(TS), "DAY").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("minutes"))
        early = F.col(TS) < F.lit("2024-01-16").cast("timestamp_ntz")
        wrong = lambda d: d.where(early).withColumn(VALUE, F.col(VALUE) + 1)
        hour, day = grain("HOUR"), grain("DAY")
        upsert.store_all(folder, minute=wrong(minute), hour=wrong(hour), day=wrong(day), statistics=days.where("day < '2024-01-16'").withColumn("minutes", F.lit(-1.0)))
        upsert.store_all(folder, minute=minute, hour=hour, day=day, statistics=days)
        stats = upsert.read_table(spark, f"{folder}/day_stats").select(SITE, VARIABLE, F.col("day").alias(TS), F.col("minutes").alias(VALUE))
        return _grains(**{n: upsert.read_table(spark, f"{folder}/{n}") for n in ("minute", "hour", "day")}, stats=stats)

    return settled_from(spark, "run", make)


@query("raw_copies", f"""SELECT site, variable, round(value, 6) AS value, 'copy' AS kind FROM ({readings_sql()})
    UNION ALL SELECT site, variable, round(value, 6), 'conflict' FROM ({readings_sql()}) WHERE value > 90
    UNION ALL SELECT site, variable, round(value, 6), 'conflict' FROM ({readings_sql()}) WHERE value > 95""")
def raw_copies(spark, sf):
    """A pull kept as it came, which a repeated pull replaces, and conflict rows, which add up."""
    def make(folder):
        df = readings(spark, sf)
        for _ in range(2):
            upsert.raw_copy(df, folder, "2024-01-01")
        for least in (90, 95):
            upsert.append_conflicts(df.where(F.col(VALUE) > least), f"{folder}/conflicts")
        read = lambda p, kind: spark.read.option("header", "true").csv(p).select(
            SITE, VARIABLE, rounded(F.col(VALUE).cast("double")).alias(VALUE), F.lit(kind).alias("kind"))
        return read(f"{folder}/2024-01-01", "copy").unionByName(read(f"{folder}/conflicts", "conflict"))

    return settled_from(spark, "copies", make)


@query("event_store", f"""
    WITH b AS (SELECT o_orderkey AS id, 'site_' || o_custkey AS site, o_orderdate AS start_time_pt, {KINDS} AS event_type, {DETAIL} AS event_detail,
        CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || o_orderkey % 3 END AS variable_name FROM orders),
    l AS (SELECT * EXCLUDE (id), start_time_pt + INTERVAL 1 DAY AS e, 1 AS load FROM b WHERE id % 2 = 0
          UNION ALL SELECT * EXCLUDE (id), start_time_pt + INTERVAL 3 DAY, 2 FROM b WHERE id % 4 = 0 OR id % 3 = 0)
    SELECT site, start_time_pt, max(e) AS end_time_pt, event_type, event_detail, variable_name, event_type IN ({KEPT_BY[0]}) AS summary_filtered,
           event_type IN ({KEPT_BY[1]}) AS optim_filtered, 'automatic_upload' AS last_modified_by,
           CASE max(load) WHEN 1 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS last_modified_date
    FROM l GROUP BY site, start_time_pt, event_type, event_detail, variable_name""")
def event_store(spark, sf):
    """Two loads of the event store; the second one updates, and adds months."""
    def make(folder):
        base = table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("id"), F.concat(F.lit("site_"), "o_custkey").alias(SITE), F.col("o_orderdate").cast("timestamp_ntz").alias("start_time_pt"),
            F.expr(KINDS).alias("event_type"), F.expr(DETAIL).alias("event_detail"),
            F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || o_orderkey % 3 END").alias("variable_name"))
        for which, days, now in (("id % 2 = 0", 1, "2024-02-01"), ("id % 4 = 0 OR id % 3 = 0", 3, "2024-02-02")):
            new = base.where(which).withColumn("end_time_pt", F.col("start_time_pt") + F.expr(f"INTERVAL '{days}' DAY"))
            site_events.load_events(new, folder, now=F.lit(now).cast("timestamp_ntz"))
        return site_events.stored_events(spark, folder).drop("id")

    return settled_from(spark, "events", make)


@query("alarm_history", f"""WITH {SESSIONS} SELECT site, alarm_type, variable_name, min(start_time_pt) AS start_time_pt, max(end_time_pt) AS end_time_pt
    FROM g GROUP BY site, alarm_type, variable_name, grp""")
def alarm_history(spark, sf):
    """Sessions of alarms that arrive in two loads, stored by month."""
    def make(folder):
        rows = _alarms(spark, sf).withColumn("start_time_pt", F.col("start_time_pt").cast("timestamp_ntz")).withColumn(
            "end_time_pt", F.col("end_time_pt").cast("timestamp_ntz"))
        for rest in (0, 1):
            alarm_store.load_history(rows.where(F.pmod("o_orderkey", F.lit(2)) == rest).drop("o_orderkey"), folder)
        return alarm_store.stored_history(spark, folder)[0].drop("id")

    return settled_from(spark, "history", make)


@query("ingested_files", f"SELECT 'lab' AS site, sec AS ts, name AS variable, max(v) AS value FROM ({BOTH}) GROUP BY ALL HAVING max(v) IS NOT NULL")
def ingested_files(spark, sf):
    """Landed logger files of two days, taken in by a stream that is started twice, with few files a batch."""
    def make(folder):
        lines = _wide_lines(spark, sf)
        one = lines.groupBy("DateTime").agg(*[F.max(n).alias(n) for n in EVENT_TYPES])
        for part in (0, 1):
            one.where(F.pmod(F.xxhash64("DateTime"), F.lit(2)) == part).repartition(3, "DateTime").write.mode("append").option(
                "header", "true").csv(f"{folder}/in")
            run = incremental.ingest_files(spark, f"{folder}/in", "csv", "lab", f"{folder}/table", f"{folder}/checkpoint", files_per_batch=2)
            run.awaitTermination()
        return upsert.read_table(spark, f"{folder}/table").where(F.col(VALUE).isNotNull()).select(SITE, TS, VARIABLE, VALUE)

    return settled_from(spark, "ingest", make)


STREAM = "site string, variable string, ts timestamp_ntz, value double"


def _periods(spark, sf, folder: str, rules=None) -> None:
    """Readings arrive in three batches that know no order in time."""
    df = readings(spark, sf)
    for part in range(3):
        df.where(F.pmod(F.xxhash64(TS, VALUE), F.lit(3)) == part).select(SITE, VARIABLE, TS, VALUE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(STREAM).parquet(f"{folder}/in")
        incremental.store_periods(stream, f"{folder}/t", f"{folder}/checkpoint", 0.02, 0.3, rules=rules).awaitTermination()


@query("stream_periods", f"""
    WITH m AS (SELECT site, variable, date_trunc('minute', ts) AS ts, avg(value) AS value FROM ({readings_sql()}) GROUP BY ALL),
    r AS (SELECT site, date_trunc('hour', ts) AS hour, count(DISTINCT ts) AS rows FROM m GROUP BY ALL),
    n AS (SELECT DISTINCT site, variable, date_trunc('day', ts) AS day FROM m),
    v AS (SELECT site, variable, date_trunc('hour', ts) AS hour, sum(value) AS s, count(value) AS n FROM m GROUP BY ALL),
    h AS (SELECT r.site, n.variable, r.hour, day, rows, s, coalesce(v.n, 0) AS n FROM r JOIN n ON r.site = n.site AND date_trunc('day', r.hour) = n.day
          LEFT JOIN v ON v.site = r.site AND v.variable = n.variable AND v.hour = r.hour)
    SELECT 'HOUR' AS grain, site, variable, hour AS ts, round(CASE WHEN n >= 1.2 THEN s / n END, 6) AS value FROM h WHERE rows >= 1.2
    UNION ALL SELECT 'DAY', site, variable, day, round(CASE WHEN count(*) FILTER (WHERE rows >= 1.2 AND n >= 1.2) >= 7.2 THEN sum(s) / sum(n) END, 6)
    FROM h GROUP BY site, variable, day HAVING count(*) FILTER (WHERE rows >= 1.2) >= 7.2""")
def stream_periods(spark, sf):
    """Complete hours and days of a stream whose readings come in any order."""
    def make(folder):
        _periods(spark, sf, folder)
        found = {n: upsert.read_table(spark, f"{folder}/t/{n}") for n in ("hour", "day")}
        return _grains(**{n: t for n, t in found.items() if t is not None})

    return settled_from(spark, "periods", make)


@query("stream_streaks", f"""
    WITH m AS (SELECT site, variable, date_trunc('minute', ts) AS ts, avg(value) AS value FROM ({readings_sql()}) GROUP BY ALL),
    i AS (SELECT *, date_trunc('day', ts) AS day, value > 40 AS hit, row_number() OVER (PARTITION BY site, variable, date_trunc('day', ts) ORDER BY ts)
        - row_number() OVER (PARTITION BY site, variable, date_trunc('day', ts), value > 40 ORDER BY ts) AS isl FROM m),
    k AS (SELECT *, row_number() OVER (PARTITION BY site, variable, day, hit, isl ORDER BY ts) AS nth FROM i)
    SELECT site, variable, 'high' AS rule, min(ts) FILTER (WHERE nth = 2) - INTERVAL 1 MINUTE AS start, max(ts) AS "end", CAST(count(*) AS INTEGER) AS length
    FROM k WHERE hit GROUP BY site, variable, day, isl HAVING count(*) >= 2""")
def stream_streaks(spark, sf):
    """Streaks of a stream whose readings come in any order; a late one joins two streaks."""
    def make(folder):
        _periods(spark, sf, folder, {"high": ("value > 40", 2)})
        return incremental.stored_streaks(spark, f"{folder}/t")

    return settled_from(spark, "streaks", make)

"""Queries for what is stored: upserts, events, alarm tables, marks."""

from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import readings, readings_sql, rounded, table
from wattloom.model import SITE, TS, VALUE
from wattloom.sinks import alarm_store, events, upsert
from wattloom.sources import marks


@query("upsert_keep_existing", """
    WITH t AS (SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS state FROM orders WHERE o_orderkey % 3 <> 0),
    s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice + 1 END AS price, o_custkey AS cust
          FROM orders WHERE o_orderkey % 2 = 0)
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, round(coalesce(s.price, t.price), 4) AS price, state, cust
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def upsert_keep_existing(spark, sf):
    orders = table(spark, sf, "orders")
    target = orders.where("o_orderkey % 3 <> 0").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("state"))
    price = F.when(F.col("o_orderkey") % 5 == 0, float("inf")).otherwise(F.col("o_totalprice") + 1)
    source = orders.where("o_orderkey % 2 = 0").select("o_orderkey", price.alias("price"), F.col("o_custkey").alias("cust"))
    return upsert.merge_keep_existing(target, source, ["o_orderkey"]).withColumn("price", rounded("price", 4))


KINDS = "CASE o_orderstatus WHEN 'O' THEN 'SITE_VISIT' WHEN 'F' THEN 'DATA_LOSS_COP' ELSE 'ALARM' END"


DETAIL = "'seen by the ' || CASE WHEN o_orderkey % 7 = 0 THEN 'second' ELSE 'first' END || ' crew, ' || o_orderpriority"
KEPT_BY = ("'MV_COMMISSIONED', 'PLANT_COMMISSIONED', 'DATA_LOSS_COP', 'SYSTEM_MAINTENANCE', 'SYSTEM_TESTING'",
           "'MV_COMMISSIONED', 'PLANT_COMMISSIONED', 'DATA_LOSS_COP', 'INSTALLATION_ERROR_COP', 'PARTIAL_OCCUPANCY', 'SOO_PERIOD_COP', "
           "'SYSTEM_TESTING', 'EQUIPMENT_MALFUNCTION', 'SYSTEM_MAINTENANCE'")


@query("event_upsert", f"""
    WITH stored AS (SELECT o_orderkey AS id, 'site_' || o_custkey AS site, o_orderdate AS start_time_pt, o_orderdate + INTERVAL 1 DAY AS end_time_pt,
            {KINDS} AS event_type, {DETAIL} AS event_detail,
            CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || o_orderkey % 3 END AS variable_name,
            CASE WHEN o_orderkey % 5 = 0 THEN 'operator' ELSE 'automatic_upload' END AS last_modified_by FROM orders WHERE o_orderkey % 2 = 0),
    new AS (SELECT o_orderkey, 'site_' || o_custkey AS site, o_orderdate AS start_time_pt, o_orderdate + INTERVAL 3 DAY AS end_time_pt, {KINDS} AS event_type,
            {DETAIL} AS event_detail, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || o_orderkey % 3 END AS variable_name
            FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 3 = 0),
    keyed AS (SELECT site, start_time_pt, event_type, coalesce(variable_name, '') AS v, event_detail AS h, max(end_time_pt) AS e FROM new GROUP BY ALL),
    old AS (SELECT *, coalesce(variable_name, '') AS v, event_detail AS h,
            row_number() OVER (PARTITION BY site, start_time_pt, event_type, coalesce(variable_name, ''), event_detail ORDER BY id) AS rn FROM stored)
    SELECT id, o.site, o.start_time_pt, CASE WHEN k.site IS NOT NULL AND rn = 1 AND last_modified_by = 'automatic_upload' THEN k.e ELSE o.end_time_pt END AS end_time_pt,
           o.event_type, event_detail, variable_name, last_modified_by, CAST(NULL AS BOOLEAN) AS summary_filtered, CAST(NULL AS BOOLEAN) AS optim_filtered
    FROM old o LEFT JOIN keyed k ON o.site = k.site AND o.start_time_pt = k.start_time_pt AND o.event_type = k.event_type AND o.v = k.v AND o.h = k.h
    UNION ALL
    SELECT NULL, k.site, k.start_time_pt, k.e, k.event_type, h, nullif(k.v, ''), 'automatic_upload', k.event_type IN ({KEPT_BY[0]}), k.event_type IN ({KEPT_BY[1]})
    FROM keyed k
    WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.site = k.site AND o.start_time_pt = k.start_time_pt AND o.event_type = k.event_type AND o.v = k.v AND o.h = k.h)""")
def event_upsert(spark, sf):
    orders = table(spark, sf, "orders")
    base = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("site_"), "o_custkey").alias(SITE), F.col("o_orderdate").alias("start_time_pt"),
        (F.col("o_orderdate") + F.expr("INTERVAL '1' DAY")).alias("end_time_pt"), F.expr(KINDS).alias("event_type"),
        F.expr(DETAIL).alias("event_detail"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'v' || o_orderkey % 3 END").alias("variable_name"))
    stored = base.where("id % 2 = 0").withColumns({
        "last_modified_by": F.when(F.col("id") % 5 == 0, "operator").otherwise(events.UPLOADER),
        "last_modified_date": F.col("start_time_pt")})
    new = base.where("id % 4 = 0 OR id % 3 = 0").drop("id").withColumn("end_time_pt", F.col("start_time_pt") + F.expr("INTERVAL '3' DAY"))
    out = events.upsert_events(stored, new, F.lit("2024-02-01").cast("timestamp_ntz"))
    # ids of new events are hashes; stored ones have no flags here
    own = F.when(F.col("summary_filtered").isNull(), F.col("id")).alias("id")
    return out.select(own, SITE, "start_time_pt", "end_time_pt", "event_type", "event_detail", "variable_name", "last_modified_by",
                      "summary_filtered", "optim_filtered")


@query("data_loss", f"""
    WITH n AS (SELECT site, max(ts) AS newest FROM (SELECT 'u' || CAST(user_id AS VARCHAR) AS site, ts FROM events) GROUP BY 1)
    SELECT site, TIMESTAMP '2024-02-01' AS start_time_pt, 'DATA_LOSS_COP' AS event_type FROM n
    WHERE TIMESTAMP '2024-02-01' - newest > INTERVAL 3 DAY AND site NOT IN (SELECT 'u' || CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderkey % 40 = 0)""")
def data_loss(spark, sf):
    rows = table(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias(SITE), TS)
    stored = table(spark, sf, "orders").select(
        F.concat(F.lit("u"), "o_custkey").alias(SITE), F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("end_time_pt"),
        F.lit("DATA_LOSS_COP").alias("event_type"))
    out = events.data_loss_events(rows, stored, F.lit("2024-02-01").cast("timestamp_ntz"))
    return out.select(SITE, "start_time_pt", "event_type")


ALARM_ROWS = """SELECT 'site_' || o_custkey % 100 AS site, o_orderdate AS start_time_pt, o_orderdate + to_hours(o_orderkey % 30 + 1) AS end_time_pt,
    'TMPRANG' AS alarm_type, 'Temp_' || o_orderstatus AS variable_name, CAST(o_orderkey % 3 + 1 AS INTEGER) AS certainty, o_orderkey FROM orders"""


def _alarms(spark, sf):
    hours = F.make_dt_interval(F.lit(0), (F.pmod("o_orderkey", F.lit(30)) + 1).cast("int"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("site_"), F.pmod("o_custkey", F.lit(100)).cast("string")).alias(SITE), F.col("o_orderdate").alias("start_time_pt"),
        (F.col("o_orderdate") + hours).alias("end_time_pt"), F.lit("TMPRANG").alias("alarm_type"),
        F.concat(F.lit("Temp_"), "o_orderstatus").alias("variable_name"), (F.pmod("o_orderkey", F.lit(3)) + 1).cast("int").alias("certainty"),
        "o_orderkey")


SESSIONS = f"""a AS ({ALARM_ROWS}), r AS (SELECT *, max(end_time_pt) OVER (PARTITION BY site, variable_name ORDER BY start_time_pt, end_time_pt, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM a),
    g AS (SELECT *, sum(CASE WHEN start_time_pt - reach < INTERVAL 4 DAY THEN 0 ELSE 1 END) OVER (
        PARTITION BY site, variable_name ORDER BY start_time_pt, end_time_pt, o_orderkey ROWS UNBOUNDED PRECEDING) AS grp FROM r)"""


def _tables(spark, sf):
    """Even orders are stored as parents and segments, the rest is new."""
    rows = _alarms(spark, sf)
    new, old = rows.where("o_orderkey % 2 = 1"), rows.where("o_orderkey % 2 = 0")
    parents, segments = alarm_store.alarm_tables(old)
    return alarm_store.alarm_tables(new, parents, segments)


@query("alarm_parents", f"""WITH {SESSIONS} SELECT site, alarm_type, variable_name, min(start_time_pt) AS start_time_pt, max(end_time_pt) AS end_time_pt
    FROM g GROUP BY site, alarm_type, variable_name, grp""")
def alarm_parents(spark, sf):
    return _tables(spark, sf)[0].drop("id")


@query("alarm_segments", f"""
    WITH {SESSIONS}, p AS (SELECT site, variable_name, grp, start_time_pt AS t0 FROM g UNION SELECT site, variable_name, grp, end_time_pt FROM g),
    e AS (SELECT *, lead(t0) OVER (PARTITION BY site, variable_name, grp ORDER BY t0) AS until FROM p),
    c AS (SELECT e.site, e.variable_name, e.grp, e.t0, e.until, coalesce(max(certainty), 0) AS level FROM e LEFT JOIN g
          ON e.site = g.site AND e.variable_name = g.variable_name AND e.grp = g.grp AND g.start_time_pt <= e.t0 AND g.end_time_pt >= e.until
          WHERE e.until IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
    i AS (SELECT *, row_number() OVER (PARTITION BY site, variable_name, grp ORDER BY t0)
        - row_number() OVER (PARTITION BY site, variable_name, grp, level ORDER BY t0) AS isl FROM c)
    SELECT site, 'TMPRANG' AS alarm_type, variable_name, min(t0) AS start_time_pt, max(until) AS end_time_pt, CAST(level AS INTEGER) AS certainty
    FROM i WHERE level > 0 GROUP BY site, variable_name, grp, level, isl""")
def alarm_segments(spark, sf):
    return _tables(spark, sf)[1].drop("id")


@query("high_water_mark", f"""
    WITH m AS (SELECT site, max(ts) AS t FROM ({readings_sql()}) GROUP BY 1), s(site) AS (VALUES ('site_0'), ('site_1'), ('site_2'), ('site_none'))
    SELECT s.site, CASE WHEN t IS NULL THEN TIMESTAMP '2000-01-09 23:59:00' WHEN strftime(t, '%H:%M') = '23:59' THEN t
        ELSE date_trunc('day', t) - INTERVAL 1 MINUTE END AS mark FROM s LEFT JOIN m ON s.site = m.site""")
def high_water_mark(spark, sf):
    from wattloom.model import literal_table

    sites = literal_table(spark, [("site_0",), ("site_1",), ("site_2",), ("site_none",)], "site string")
    return marks.last_full_day(readings(spark, sf), sites)


@query("row_at_time", f"SELECT site, ts, variable, value FROM ({readings_sql()}) WHERE ts = (SELECT max(ts) FROM events)")
def row_at_time(spark, sf):
    df = readings(spark, sf)
    newest = df.agg(F.max(TS)).first()[0]
    return marks.row_at(df, newest)


@query("reprocess_merge", f"""
    SELECT site, ts, variable, value FROM ({readings_sql()}) WHERE ts <= TIMESTAMP '2024-01-20 23:59:00'
    UNION ALL SELECT site, ts, variable, value + 1 FROM ({readings_sql()}) WHERE ts > TIMESTAMP '2024-01-20 23:59:00' AND site <> 'site_3'""")
def reprocess_merge(spark, sf):
    """History up to each site's mark, then the new pull."""
    stored = readings(spark, sf)
    pulled = stored.where(F.col(SITE) != "site_3").withColumn(VALUE, F.col(VALUE) + 1)
    marks_table = stored.select(SITE).distinct().withColumn("mark", F.lit("2024-01-20 23:59:00").cast("timestamp_ntz"))
    return marks.merge_history(stored, pulled, marks_table)

"""Alarm queries. The hour slots of `events` stand for a plant's readings; one row per hour."""

from pyspark.sql import DataFrame, functions as F

from wattloom.catalog.aggregation import SCHEDULE, schedule
from wattloom.catalog.registry import query
from wattloom.catalog.tables import grain_readings, grain_sql, rounded, table
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE, complete_rows, literal_table
from wattloom.operators import alarms
from wattloom.operators.alarms import codes, detectors
from wattloom.session import cut_lineage

SENSORS = {
    "click": "PowerIn_HPWH1", "error": "PowerIn_SwingTank1", "purchase": "PowerIn_Total",
    "signup": "Temp_HPWH1_Outlet", "view": "Setpoint_SwingTank1",
}
GRAIN = "HOUR"
RULES = [
    ("PowerIn_HPWH1", "BLWNFSE:60;HPINLET:20;HPOUTLT:20;SHRTCYC:40;POWRRAT:85-200;HPOUTGE:0.98;SOOCHNG:40;BALVALV;TMNSTPT:20", "pump", None, None, None),
    ("PowerIn_SwingTank1", "IMBCKUP;POWRRAT:90-110", None, None, "45", "2"),
    ("PowerIn_Total", "TMNSTPT:1.1;IMBCKUP:1.0;POWRRAT;HPOUTGE;BALVALV:1.0", None, None, None, None),
    ("Temp_HPWH1_Outlet", "TMPRANG:20-90;HPINLET:30;HPOUTLT:70;TMNSTPT:30;SOOCHNG_ON:50;SOOCHNG_OFF:60;"
     "SOOCHNG_ON_shed:50;SOOCHNG_OFF_shed:60", "outlet", "20", "none", "3"),
    ("Setpoint_SwingTank1", "TMNSTPT:50;IMBCKUP:50;ABNRMCP:40-60;SOOSCHD_normal:50;SOOSCHD_loadUp:10", None, None, None, None),
]
NAME = "CASE variable " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENSORS.items()) + " END"


def plant(spark, sf, shared: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Readings, daily means and rules of two sites.

    ``shared`` stores the hour slots once, for queries whose branches would each derive them again.
    """
    # rounded, as messages show readings with all their digits
    hours = grain_readings(spark, sf, sites=2).withColumn(VALUE, rounded(VALUE))
    labels = F.create_map(*[F.lit(x) for pair in SENSORS.items() for x in pair])
    minute = complete_rows(hours.withColumn(VARIABLE, F.element_at(labels, F.col(VARIABLE))))
    if shared:
        minute = cut_lineage(minute)
    daily = minute.groupBy(SITE, VARIABLE, floor_time(F.col(TS), "DAY").alias(TS)).agg(F.avg(VALUE).alias(VALUE))
    rules = literal_table(
        spark, RULES,
        "variable_name string, alarm_codes string, pretty_name string, low_alarm string, high_alarm string, fault_time string")
    return minute, daily, rules


PLANT = f"""h AS (SELECT site, {NAME} AS variable, ts, round(value, 6) AS value FROM ({grain_sql(sites=2)})),
    m AS (SELECT a.site, a.ts, date_trunc('day', a.ts) AS day, b.variable, h.value
          FROM (SELECT DISTINCT site, ts FROM h) a JOIN (SELECT DISTINCT site, variable FROM h) b ON a.site = b.site
          LEFT JOIN h ON h.site = a.site AND h.ts = a.ts AND h.variable = b.variable),
    d AS (SELECT site, variable, day AS ts, avg(value) AS value FROM m GROUP BY 1, 2, 3),
    wide AS (SELECT site, ts, day,
        max(value) FILTER (WHERE variable = 'PowerIn_HPWH1') AS p, max(value) FILTER (WHERE variable = 'PowerIn_Total') AS total,
        max(value) FILTER (WHERE variable = 'PowerIn_SwingTank1') AS tank,
        max(value) FILTER (WHERE variable = 'Temp_HPWH1_Outlet') AS t, max(value) FILTER (WHERE variable = 'Setpoint_SwingTank1') AS sp
        FROM m GROUP BY 1, 2, 3),
    wd AS (SELECT site, ts,
        max(value) FILTER (WHERE variable = 'PowerIn_HPWH1') AS p, max(value) FILTER (WHERE variable = 'PowerIn_Total') AS total,
        max(value) FILTER (WHERE variable = 'PowerIn_SwingTank1') AS tank,
        max(value) FILTER (WHERE variable = 'Setpoint_SwingTank1') AS sp FROM d GROUP BY 1, 2)"""


AT = "strftime(s, '%Y-%m-%d %H:%M:%S')"
ACTUAL = "CASE WHEN actual IS NULL THEN 'nan' ELSE CAST(actual AS VARCHAR) END"


def shown(number: str, digits: int = 1) -> str:
    """Rounded half up on the shortest decimal form, as messages are."""
    return f"CASE WHEN {number} IS NULL THEN 'nan' ELSE CAST(round(CAST(CAST({number} AS VARCHAR) AS DECIMAL(28, 12)), {digits}) AS VARCHAR) END"


def streak_sql(source: str, need: int, tag: str, variable: str, certainty: int = 3, scope: str = "site, day", detail: str = "''",
               actual: str = "NULL", trigger: int | None = None) -> str:
    """Streaks of `mask` in `source(scope..., ts, mask)` as alarms; ``actual`` is a column's value on the row that triggers."""
    trigger = need if trigger is None else trigger
    return f"""SELECT * EXCLUDE (actual), {detail} AS detail FROM (
        SELECT site, min(ts) FILTER (WHERE nth = {need}) - to_hours({need - 1}) AS s, max(ts) + INTERVAL 1 HOUR AS e,
        '{tag}' AS alarm_type, '{variable}' AS variable_name, {certainty} AS certainty, count(*) AS n,
        max({actual}) FILTER (WHERE nth = {trigger}) AS actual
        FROM (SELECT *, row_number() OVER (PARTITION BY {scope}, mask, isl ORDER BY ts) AS nth FROM (
            SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY ts)
                    - row_number() OVER (PARTITION BY {scope}, mask ORDER BY ts) AS isl
            FROM (SELECT * REPLACE (coalesce(mask, FALSE) AS mask) FROM ({source})))) WHERE mask
        GROUP BY {scope}, isl HAVING count(*) >= {need})"""


def daily_sql(condition: str, tag: str, variable: str, certainty: int, extra: str = "", detail: str = "''") -> str:
    return f"""SELECT site, ts AS s, ts + INTERVAL 1 DAY {extra} AS e, '{tag}' AS alarm_type, '{variable}' AS variable_name,
        {certainty} AS certainty, 0 AS n, {detail} AS detail FROM wd WHERE {condition}"""


def merged_sql(*parts: str, setup: str = "") -> str:
    union = " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return f"""WITH {PLANT}{setup}, x AS ({union}),
        a AS (SELECT site, s, max(e) AS e, alarm_type, variable_name, certainty, min(detail) AS detail FROM x
              GROUP BY site, s, alarm_type, variable_name, certainty),
        r AS (SELECT *, max(e) OVER (PARTITION BY site, variable_name, alarm_type, certainty ORDER BY s, e
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM a),
        g AS (SELECT *, sum(CASE WHEN s <= reach + INTERVAL 1 MINUTE THEN 0 ELSE 1 END) OVER (
              PARTITION BY site, variable_name, alarm_type, certainty ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS grp FROM r)
        SELECT site, min(s) AS start_time_pt, max(e) AS end_time_pt, alarm_type, variable_name,
               CAST(certainty AS INTEGER) AS certainty, arg_min(detail, s) AS event_detail
        FROM g GROUP BY site, alarm_type, variable_name, certainty, grp"""


BOUNDARY_SQL = [
    streak_sql("SELECT site, day, ts, t < 20 AS mask FROM wide", 3, "BOUNDRY", "Temp_HPWH1_Outlet",
               detail="'Boundary alarm for outlet'"),
    streak_sql("SELECT site, day, ts, tank > 45 AS mask FROM wide", 2, "BOUNDRY", "PowerIn_SwingTank1",
               detail="'Boundary alarm for PowerIn_SwingTank1'"),
]
RANGE_TEXT = f"'Temperature out of range: outlet was outside 20.0-90.0 F for ' || n || ' consecutive minutes starting at ' || {AT} || '.'"
TEMP_SQL = [streak_sql("SELECT site, day, ts, t < 20 OR t > 90 AS mask FROM wide", 2, "TMPRANG", "Temp_HPWH1_Outlet")]
FUSE_SQL = [streak_sql("SELECT site, day, ts, p > 1 AND p < 58 AS mask FROM wide", 3, "BLWNFSE", "PowerIn_HPWH1", detail=f"""
    'Blown Fuse: PowerIn_HPWH1 had a power draw less than 58.0 while element was ON starting at ' || {AT} || '.'""")]
INLET_TEXT = f"""'High heat pump inlet temperature: outlet was above 30.0 F for ' || n || ' minutes while HP was ON starting at ' || {AT} || '.'"""
OUTLET_TEXT = f"""'Low heat pump outlet temperature: outlet was ' || {shown('actual')} || ' F (below 70.0 F) for ' || n
    || ' minutes while HP was ON starting at ' || {AT} || '.'"""
INLET_SQL = [streak_sql("SELECT site, day, ts, p > 20 AND t > 30 AS mask FROM wide", 3, "HPINLET", "Temp_HPWH1_Outlet", detail=INLET_TEXT)]
OUTLET_SQL = [streak_sql(
    """SELECT site, day, ts, t, q > 0 AND coalesce(on_, FALSE) AND nth > 2 AND t < 70 AS mask FROM (
        SELECT *, 1 AS q, row_number() OVER (PARTITION BY site, day, on_, isl ORDER BY ts) AS nth FROM (
            SELECT *, row_number() OVER (PARTITION BY site, day ORDER BY ts)
                    - row_number() OVER (PARTITION BY site, day, on_ ORDER BY ts) AS isl
            FROM (SELECT *, coalesce(p > 20, FALSE) AS on_ FROM wide)))""", 1, "HPOUTLT", "Temp_HPWH1_Outlet", detail=OUTLET_TEXT, actual="t")]
ALTERED = "SELECT site, day, ts, sp, sp IS DISTINCT FROM 50 AS mask FROM wide"
ALTERED_TEXT = f"""Setpoint_SwingTank1 was ' || {ACTUAL} || ' for ' || n || ' minutes starting at ' || {AT} || ' (expected 50.0).'"""
TM_SQL = [
    streak_sql(ALTERED, 10, "TMNSTPT", "Setpoint_SwingTank1", detail=f"'Setpoint altered: {ALTERED_TEXT}", actual="sp"),
    streak_sql("SELECT site, day, ts, t, p >= 20 AND t >= 30 AS mask FROM wide", 3, "TMNSTPT", "PowerIn_HPWH1", 2, detail=f"""
        'High TM Setpoint: pump showed draw for ' || n || ' minutes starting at ' || {AT} || ' while outlet was ' || {shown('actual')}
        || ' F (above 30.0 F).'""", actual="t"),
    daily_sql("total <> 0 AND coalesce(p, 0) / total > 1.1", "TMNSTPT", "PowerIn_Total", 1, detail=f"""
        'High temperature maintenance power ratio: TM heating accounted for ' || {shown('coalesce(p, 0) / total * 100')}
        || '% of daily power (threshold ' || CAST(1.1::DOUBLE * 100 AS VARCHAR) || '%).'"""),
]
BACKUP_SQL = [
    streak_sql(ALTERED, 10, "IMBCKUP", "Setpoint_SwingTank1", detail=f"'Swing tank setpoint was altered: {ALTERED_TEXT}", actual="sp"),
    daily_sql("coalesce(tank, 0) >= total", "IMBCKUP", "PowerIn_Total", 2, "+ INTERVAL 1 HOUR", detail=f"""
        'Improper Back Up Use: Sum of back up equipment (' || {shown('coalesce(tank, 0)', 2)} || ') exceeds 100.00% of total power.'"""),
]
BALANCE_SQL = [daily_sql("coalesce(p, 0) >= total * 1.0", "BALVALV", "PowerIn_Total", 1, detail=f"""
    'Recirculation imbalance: Sum of recirculation equipment (' || {shown('coalesce(p, 0)', 2)}
    || ') exceeds or equals 100.00% of total power.'""")]
COP_SQL = [daily_sql("sp > 60 OR sp < 40", "ABNRMCP", "Setpoint_SwingTank1", 3, detail="""
    'Unexpected COP Value detected: Setpoint_SwingTank1 = ' || CAST(round(sp, 2) AS VARCHAR)""")]
BLOCKS = """, b AS (SELECT site, ts, coalesce(sum(p) OVER w, 0) AS p, coalesce(sum(tank) OVER w, 0) AS tank,
        coalesce(sum(total) OVER w, 0) AS total, count(*) OVER w AS k FROM wd
        WINDOW w AS (PARTITION BY site ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
RATIO_SQL = [
    """SELECT site, ts - INTERVAL 6 DAY AS s, ts + INTERVAL 1 DAY AS e, 'POWRRAT' AS alarm_type,
        'PowerIn_SwingTank1' AS variable_name, 3 AS certainty, 0 AS n,
        'Power ratio alarm (7-day block ending ' || strftime(ts, '%Y-%m-%d') || '): PowerIn_SwingTank1 accounted for '
        || CASE WHEN total = 0 THEN CASE WHEN tank > 0 THEN 'Infinity' ELSE '-Infinity' END ELSE CAST(round(CAST(CAST(tank / total * 100 AS VARCHAR) AS DECIMAL(28, 12)), 1) AS VARCHAR) END
        || '% of Total energy use. 90.0-110.0% expected.' AS detail FROM b
        WHERE k = 7 AND (tank / total * 100 < 90 OR tank / total * 100 > 110)""",
    """SELECT site, ts - INTERVAL 6 DAY AS s, ts + INTERVAL 1 DAY AS e, 'POWRRAT' AS alarm_type,
        'PowerIn_HPWH1' AS variable_name, 3 AS certainty, 0 AS n, '' AS detail FROM b WHERE k = 7 AND p / p * 100 < 85""",
]
OUTAGE_SQL = ["""SELECT site, ts AS s, ts + INTERVAL 1 DAY AS e, 'HPOUTGE' AS alarm_type, 'PowerIn_HPWH1' AS variable_name,
    2 AS certainty, 0 AS n, 'Possible Heat Pump failure or outage.' AS detail FROM b WHERE k = 7 AND p < total * 0.98"""]
SHORT_SQL = [f"""SELECT *, 'Short cycle: pump was on for only ' || n || ' minutes starting at ' || {AT} || '.' AS detail FROM (
        SELECT site, min(ts) AS s, max(ts) + INTERVAL 1 HOUR AS e, 'SHRTCYC' AS alarm_type,
        'PowerIn_HPWH1' AS variable_name, 3 AS certainty, count(*) AS n FROM (
        SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts)
                - row_number() OVER (PARTITION BY site, mask ORDER BY ts) AS isl,
               min(ts) OVER (PARTITION BY site) AS lo, max(ts) OVER (PARTITION BY site) AS hi
        FROM (SELECT site, ts, coalesce(p > 40, FALSE) AS mask FROM wide)) WHERE mask
        GROUP BY site, isl, lo, hi HAVING count(*) < 3 AND min(ts) <> lo AND max(ts) <> hi)"""]
CHANGE_SETUP = f""", {SCHEDULE}, modes AS (
        SELECT DISTINCT w.site, w.day, w.ts, p, t, event AS mode FROM wide w JOIN sched s
            ON w.site = s.site AND w.ts >= s.start AND w.ts < s.stop
        UNION ALL SELECT site, day, ts, p, t, 'normal' FROM wide w WHERE NOT EXISTS (
            SELECT 1 FROM sched s WHERE w.site = s.site AND w.ts >= s.start AND w.ts < s.stop)),
    turns AS (SELECT *, lag(p) OVER (PARTITION BY site, mode, day ORDER BY ts) AS before FROM modes
              WHERE mode IN ('normal', 'shed'))"""
CHANGE_SQL = [f"""SELECT site, ts AS s, ts + INTERVAL 1 HOUR AS e, 'SOOCHNG' AS alarm_type, 'Temp_HPWH1_Outlet' AS variable_name,
    2 AS certainty, 0 AS n, 'Unexpected SOO change: during ' || upper(mode) || ', HP turned ' || CASE WHEN p > 40 THEN 'on' ELSE 'off' END
    || ' at ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' but outlet was ' || {shown('t')} || ' F (setpoint at '
    || CASE WHEN p > 40 THEN '50.0' ELSE '60.0' END || ' F).' AS detail FROM turns WHERE (before <= 40 AND p > 40 AND abs(t - 50) > 5)
        OR (before > 40 AND p <= 40 AND abs(t - 60) > 5)"""]
MISMATCH_SETUP = f""", {SCHEDULE}, sch AS (
        SELECT w.site, w.day, w.ts, s.seq, sp, sp IS DISTINCT FROM 10 AS mask FROM wide w JOIN sched s
            ON w.site = s.site AND w.ts >= s.start AND w.ts < s.stop AND event = 'loadUp'
        UNION ALL SELECT site, day, ts, -1, sp, sp IS DISTINCT FROM 50 FROM wide w WHERE NOT EXISTS (
            SELECT 1 FROM sched s WHERE w.site = s.site AND w.ts >= s.start AND w.ts < s.stop)
            AND site IN (SELECT site FROM sched))"""
MODE_TEXT = f"""'Load shift mode inconsistency: Setpoint_SwingTank1 was ' || {ACTUAL} || ' for ' || n || ' minutes starting at ' || {AT} || ' during """
MISMATCH_SQL = [
    streak_sql(f"SELECT site, day, ts, seq, sp, mask FROM sch WHERE seq {where}", 1, "SOOSCHD", "Setpoint_SwingTank1", 3, "site, day, seq",
               detail=f"{MODE_TEXT}{text}'", actual="sp")
    for where, text in (("= -1", "normal operation (expected 50.0)."), ("<> -1", "loadUp event (expected 10.0)."))]


@query("boundary_alarm", merged_sql(*BOUNDARY_SQL))
def boundary_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_boundary(minute, daily, rules, grain=GRAIN)


@query("temp_range_alarm", f"""
    WITH {PLANT}, a AS ({TEMP_SQL[0]})
    SELECT site, s AS start_time_pt, e AS end_time_pt, alarm_type, variable_name, CAST(certainty AS INTEGER) AS certainty,
        'Temperature out of range: outlet was outside 20.0-90.0 F for ' || n || ' consecutive minutes starting at '
        || strftime(s, '%Y-%m-%d %H:%M:%S') || '.' AS event_detail FROM a""")
def temp_range_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return detectors.on_days_of(
        detectors.value_streaks(minute, detectors.temp_range_rules(detectors.book(rules, "TMPRANG"), rows=2), GRAIN), daily)


@query("blown_fuse_alarm", merged_sql(*FUSE_SQL))
def blown_fuse_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_blown_fuse(minute, daily, rules, grain=GRAIN)


@query("pair_alarm", merged_sql(*INLET_SQL))
def pair_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_inlet_temp(minute, daily, rules, rows=3, grain=GRAIN)


@query("outlet_alarm", merged_sql(*OUTLET_SQL))
def outlet_alarm(spark, sf):
    """With a warm-up of two rows, as runs of ten hours are rare here."""
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_outlet_temp(minute, daily, rules, rows=1, warmup=2, grain=GRAIN)


@query("tm_setpoint_alarm", merged_sql(*TM_SQL))
def tm_setpoint_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    return alarms.flag_tm_setpoint(minute, daily, rules, grain=GRAIN)


@query("backup_use_alarm", merged_sql(*BACKUP_SQL))
def backup_use_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    return alarms.flag_backup_use(minute, daily, rules, grain=GRAIN)


@query("daily_ratio_alarm", merged_sql(*BALANCE_SQL))
def daily_ratio_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_balancing_valve(minute, daily, rules, grain=GRAIN)


@query("cop_range_alarm", merged_sql(*COP_SQL))
def cop_range_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_abnormal_cop(minute, daily, rules)


@query("rolling_block_share", merged_sql(*RATIO_SQL, setup=BLOCKS))
def rolling_block_share(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_power_ratio(minute, daily, rules)


@query("low_share_7d", merged_sql(*OUTAGE_SQL, setup=BLOCKS))
def low_share_7d(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    return alarms.flag_outage(minute, daily, rules)


@query("block_share_with_stored_days", merged_sql("""
    SELECT site, ts AS s, ts + INTERVAL 1 DAY AS e, 'HPOUTGE' AS alarm_type, 'PowerIn_HPWH1' AS variable_name,
    2 AS certainty, 0 AS n, 'Possible Heat Pump failure or outage.' AS detail FROM (SELECT *, count(*) OVER w AS k7, sum(p) OVER w AS p7, sum(total) OVER w AS t7
        FROM wd WHERE ts >= TIMESTAMP '2024-01-13' WINDOW w AS (PARTITION BY site ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    WHERE k7 = 7 AND p7 < t7 * 0.98"""))
def block_share_with_stored_days(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    return alarms.flag_outage(minute, daily.where(F.col(TS) >= cut), rules, stored=daily.where(F.col(TS) < cut))


@query("short_cycle_alarm", merged_sql(*SHORT_SQL))
def short_cycle_alarm(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_short_cycle(minute, daily, rules, rows=3, grain=GRAIN)


@query("mode_transitions", merged_sql(*CHANGE_SQL, setup=CHANGE_SETUP))
def mode_transitions(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    return alarms.flag_soo_change(minute, daily, rules, schedule(spark, sf), grain=GRAIN)


@query("mode_mismatch", merged_sql(*MISMATCH_SQL, setup=MISMATCH_SETUP))
def mode_mismatch(spark, sf):
    minute, daily, rules = plant(spark, sf)
    return alarms.flag_schedule_mismatch(minute, daily, rules, schedule(spark, sf), grain=GRAIN)


ALL_SQL = [
    *BOUNDARY_SQL,
    streak_sql("SELECT site, day, ts, t < 20 OR t > 90 AS mask FROM wide", 10, "TMPRANG", "Temp_HPWH1_Outlet", detail=RANGE_TEXT),
    *FUSE_SQL,
    streak_sql("SELECT site, day, ts, p > 20 AND t > 30 AS mask FROM wide", 5, "HPINLET", "Temp_HPWH1_Outlet", detail=INLET_TEXT),
    OUTLET_SQL[0].replace("nth > 2", "nth > 10").replace("nth = 1)", "nth = 5)").replace("to_hours(0)", "to_hours(4)").replace("count(*) >= 1", "count(*) >= 5"),
    *TM_SQL, *BACKUP_SQL, *BALANCE_SQL, *COP_SQL, *RATIO_SQL, *OUTAGE_SQL,
    SHORT_SQL[0].replace("count(*) < 3", "count(*) < 15"), *CHANGE_SQL, *MISMATCH_SQL,
]


@query("all_alarms", merged_sql(*ALL_SQL, setup=BLOCKS + CHANGE_SETUP + MISMATCH_SETUP.replace(SCHEDULE + ",", "").replace(", ,", ",")))
def all_alarms(spark, sf):
    minute, daily, rules = plant(spark, sf, shared=True)
    return alarms.all_alarms(minute, daily, rules, schedule(spark, sf), grain=GRAIN)


@query("alarm_codes", """
    SELECT p_partkey, 'Temp_' || p_partkey AS variable, 'TMPRANG' AS tag, 'Temp' AS role, 'No ID' AS element,
           CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) ELSE 115.0 END AS bound,
           CASE WHEN p_size % 2 = 0 THEN CAST(p_size + 20 AS DOUBLE) ELSE 130.0 END AS bound2 FROM part""")
def alarm_codes(spark, sf):
    """Parsing of a rule table with one rule per part."""
    size = F.col("p_size")
    code = F.when(size % 2 == 0, F.concat(F.lit("OTHER:1; TMPRANG:"), size, F.lit("-"), size + 20)).otherwise("TMPRANG")
    rules = table(spark, sf, "part").select(
        F.concat(F.lit("Temp_"), "p_partkey").alias("variable_name"), code.alias("alarm_codes"))
    parsed = codes.parse(rules, "TMPRANG", {"Temp": (115, 130)}, ranged=True)
    return parsed.select(
        F.substring(VARIABLE, 6, 20).cast("bigint").alias("p_partkey"), VARIABLE, "tag", "role", "element", "bound", "bound2")

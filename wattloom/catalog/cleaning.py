"""Cleaning queries."""

from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import grain_readings, grain_sql, readings, readings_sql, rounded, table
from wattloom.functions import units
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE, literal_table, to_wide
from wattloom.operators import cleaning
from wattloom.operators.intervals import latest
from wattloom.operators.sequences import day_segment, difference, ordered

RULES = [
    ("click", "Temp_Supply", 5.0, 120.0, 12.31, 1, None),
    ("view", "Temp_Supply", 5.0, 120.0, None, 1, None),
    ("error", "PowerIn_HPWH1", None, 80.0, 6.55, 0, 2),
    ("purchase", "Flow_City", 20.0, None, None, 0, 5),
    ("signup", "Energy_Total", None, None, None, None, None),
]
RULE_COLUMNS = (
    "variable_alias string, variable_name string, lower_bound double, upper_bound double, "
    "error_value double, changepoint int, ffill_length int"
)


def _sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


RULES_SQL = (
    "SELECT CAST(a AS VARCHAR) AS variable_alias, CAST(b AS VARCHAR) AS variable_name, "
    "CAST(c AS DOUBLE) AS lower_bound, CAST(d AS DOUBLE) AS upper_bound, CAST(e AS DOUBLE) AS error_value, "
    "CAST(f AS INTEGER) AS changepoint, CAST(g AS INTEGER) AS ffill_length FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql_value(v) for v in r) + ")" for r in RULES)
    + ") AS t(a, b, c, d, e, f, g)"
)


def rules(spark, by_alias: bool = True):
    """The rule table; ``by_alias=False`` names the raw variables, for readings not yet renamed."""
    df = literal_table(spark, RULES, RULE_COLUMNS)
    return df if by_alias else df.withColumn("variable_name", F.col("variable_alias"))


@query("floor_and_average_duplicates", f"""
    SELECT site, date_trunc('minute', ts) AS ts, variable, round(avg(value), 6) AS value
    FROM ({readings_sql()}) WHERE date_trunc('minute', ts) > TIMESTAMP '2000-01-01 00:00:00' GROUP BY 1, 2, 3""")
def floor_and_average_duplicates(spark, sf):
    out = cleaning.average_duplicates(cleaning.floor_to(readings(spark, sf), "MINUTE"))
    return out.withColumn(VALUE, rounded(VALUE))


@query("zone_shift", f"""
    SELECT site, variable, value,
           timezone('America/Los_Angeles', timezone('UTC', ts)) AS ts
    FROM ({readings_sql()})""")
def zone_shift(spark, sf):
    return cleaning.shift_zone(readings(spark, sf))


@query("site_local_time", f"""
    WITH zones(site, local_tz) AS (VALUES ('site_0', 'America/Denver'), ('site_1', 'America/New_York'))
    SELECT r.site, r.ts AS time_utc, r.variable,
           timezone(z.local_tz, timezone('UTC', r.ts)) AS time_local
    FROM ({readings_sql(2)}) r LEFT JOIN zones z ON r.site = z.site""")
def site_local_time(spark, sf):
    sites = literal_table(
        spark, [("site_0", "America/Denver"), ("site_1", "America/New_York")], "site string, local_tz string")
    df = readings(spark, sf, 2).select(SITE, F.col(TS).alias("time_utc"), VARIABLE)
    return cleaning.add_local_time(df, sites)


@query("rename_by_rules", f"""
    WITH r AS ({readings_sql()}), rules AS ({RULES_SQL}),
    renamed AS (SELECT site, ts, variable_name AS variable, value FROM r JOIN rules ON r.variable = variable_alias
                WHERE variable_alias <> 'signup')
    SELECT site, ts, variable, value FROM renamed
    WHERE (site, ts) IN (SELECT (site, ts) FROM renamed WHERE value IS NOT NULL)""")
def rename_by_rules(spark, sf):
    named = rules(spark).where("variable_alias <> 'signup'")
    return cleaning.rename_by_rules(readings(spark, sf), named)


@query("outliers_to_null", f"""
    WITH rules AS ({RULES_SQL})
    SELECT r.site, r.ts, r.variable,
           CASE WHEN r.value < coalesce(lower_bound, '-infinity'::DOUBLE)
                  OR r.value > coalesce(upper_bound, 'infinity'::DOUBLE) THEN NULL ELSE r.value END AS value
    FROM ({readings_sql()}) r LEFT JOIN rules ON r.variable = variable_alias""")
def outliers_to_null(spark, sf):
    return cleaning.outliers_to_null(readings(spark, sf), rules(spark, by_alias=False))


@query("sentinel_to_null", f"""
    WITH rules AS ({RULES_SQL})
    SELECT r.site, r.ts, r.variable, CASE WHEN r.value = error_value THEN NULL ELSE r.value END AS value
    FROM ({readings_sql()}) r LEFT JOIN rules ON r.variable = variable_alias""")
def sentinel_to_null(spark, sf):
    return cleaning.sentinel_to_null(readings(spark, sf), rules(spark, by_alias=False))


def gappy(spark, sf):
    """Hour slots with values over 60 removed: a series with gaps."""
    return grain_readings(spark, sf).withColumn(VALUE, F.when(F.col(VALUE) <= 60, F.col(VALUE)))


GAPPY_SQL = f"SELECT site, variable, ts, CASE WHEN value <= 60 THEN value END AS value FROM ({grain_sql()})"


def _fill_sql(frame: str, seed: str | None = None) -> str:
    source = GAPPY_SQL
    if seed is not None:
        source = f"""SELECT site, variable, ts, CASE WHEN value IS NULL AND
            row_number() OVER (PARTITION BY site, variable ORDER BY ts) = 1 THEN {seed} ELSE value END AS value
            FROM ({GAPPY_SQL})"""
    return f"""SELECT site, variable, ts, round(last_value(value IGNORE NULLS) OVER (
        PARTITION BY site, variable ORDER BY ts ROWS BETWEEN {frame} PRECEDING AND CURRENT ROW), 6) AS value
        FROM ({source})"""


def _fill_rules(spark, change: int, limit: int | None):
    rows = [(t, change, limit) for t in ("click", "error", "purchase", "signup", "view")]
    return literal_table(spark, rows, "variable_name string, changepoint int, ffill_length int")


@query("ffill_unbounded", _fill_sql("UNBOUNDED"))
def ffill_unbounded(spark, sf):
    out = cleaning.forward_fill(gappy(spark, sf), _fill_rules(spark, 1, None))
    return out.withColumn(VALUE, rounded(VALUE))


@query("ffill_limited", _fill_sql("2"))
def ffill_limited(spark, sf):
    out = cleaning.forward_fill(gappy(spark, sf), _fill_rules(spark, 0, 2))
    return out.withColumn(VALUE, rounded(VALUE))


@query("ffill_seeded", _fill_sql("UNBOUNDED", "length(site) + 0.5"))
def ffill_seeded(spark, sf):
    df = gappy(spark, sf)
    seed = df.select(SITE, VARIABLE).distinct().withColumn(VALUE, F.length(SITE) + 0.5)
    out = cleaning.forward_fill(df, _fill_rules(spark, 1, None), seed=seed)
    return out.withColumn(VALUE, rounded(VALUE))


@query("ffill_raw_rows", f"""
    WITH r AS (SELECT 'site_' || CAST(user_id % 10 AS VARCHAR) AS site, ts, event_type AS variable, event_id,
                      CASE WHEN value <= 60 THEN value END AS value FROM events), rules AS ({RULES_SQL}),
    f AS (SELECT *, last_value(value IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS f0,
                 last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS f2,
                 last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS f5
          FROM r WINDOW w AS (PARTITION BY site, variable ORDER BY ts, event_id))
    SELECT site, ts, variable, event_id, coalesce(value, CASE WHEN changepoint = 1 THEN f0
        WHEN ffill_length = 2 THEN f2 WHEN ffill_length = 5 THEN f5 END) AS value
    FROM f LEFT JOIN rules ON variable = variable_alias""")
def ffill_raw_rows(spark, sf):
    """Filling before duplicates are averaged: row limits count duplicate rows."""
    raw = table(spark, sf, "events").select(
        F.concat(F.lit("site_"), F.pmod("user_id", F.lit(10)).cast("string")).alias(SITE), TS,
        F.col("event_type").alias(VARIABLE), "event_id",
        F.when(F.col(VALUE) <= 60, F.col(VALUE)).alias(VALUE))
    return cleaning.forward_fill(
        raw, rules(spark, by_alias=False), seq="event_id", segment=floor_time(F.col(TS), "MINUTE"))


@query("point_correction", f"""
    SELECT r.site, r.ts, r.variable, CASE WHEN c.event_id IS NOT NULL THEN -1.0 ELSE r.value END AS value
    FROM (SELECT 'site_' || CAST(user_id % 10 AS VARCHAR) AS site, ts, event_type AS variable, value, event_id
          FROM events) r
    LEFT JOIN (SELECT event_id FROM events WHERE value > 200) c ON r.event_id = c.event_id""")
def point_correction(spark, sf):
    df = readings(spark, sf)
    fixes = df.where("value > 200").select(SITE, TS, VARIABLE, F.lit(-1.0).alias("new_value"))
    return cleaning.correct_points(df, fixes)


def _wide(spark, sf):
    return to_wide(grain_readings(spark, sf, sites=2), ["click", "view", "error", "purchase", "signup"])


WIDE_SQL = ("SELECT site, ts, " + ", ".join(
    f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in ("click", "view", "error", "purchase", "signup"))
    + f" FROM ({grain_sql(sites=2)}) GROUP BY site, ts")


@query("rename_history", f"""
    SELECT site, ts, round(CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN click ELSE view END, 6) AS view
    FROM ({WIDE_SQL})""")
def rename_history(spark, sf):
    out = cleaning.rename_history(_wide(spark, sf), "2024-01-15 00:00:00", "view", "click")
    return out.select(SITE, TS, rounded("view").alias("view"))


@query("sensor_adjustment", f"""
    SELECT site, ts,
           CASE WHEN site = 'site_1' AND ts >= TIMESTAMP '2024-01-10' AND variable = 'click' THEN 'view'
                WHEN site = 'site_1' AND ts >= TIMESTAMP '2024-01-10' AND variable = 'view' THEN 'click'
                ELSE variable END AS variable,
           CASE WHEN site = 'site_2' AND ts >= TIMESTAMP '2024-01-20' AND variable = 'error' THEN NULL
                ELSE value END AS value
    FROM ({readings_sql()})""")
def sensor_adjustment(spark, sf):
    return cleaning.adjust_sensors(readings(spark, sf), [
        cleaning.Adjustment("site_1", "2024-01-10 00:00:00", "swap", "click", "view"),
        cleaning.Adjustment("site_2", "2024-01-20 00:00:00", "remove", "error"),
        cleaning.Adjustment("site_3", "2024-01-20 00:00:00", "add", "extra"),
    ])


@query("cumulative_to_delta", """
    WITH c AS (SELECT CAST(o_custkey AS VARCHAR) AS site, o_orderdate AS ts, o_orderkey,
        round(o_totalprice * 100) AS cents FROM orders),
    r AS (SELECT *, sum(cents) OVER (PARTITION BY site ORDER BY ts, o_orderkey) AS register FROM c)
    SELECT site, ts, o_orderkey,
        register - lag(register) OVER (PARTITION BY site ORDER BY ts, o_orderkey) AS value FROM r""")
def cumulative_to_delta(spark, sf):
    """A register that adds up order cents per customer, and the difference that undoes it."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(SITE), F.col("o_orderdate").alias(TS), "o_orderkey",
        F.round(F.col("o_totalprice") * 100).alias("cents"))
    order = [TS, "o_orderkey"]
    register = ordered(orders, [SITE], order, day_segment(), total={VALUE: F.col("cents")})
    return difference(register, VALUE, [SITE], order, day_segment()).select(SITE, TS, "o_orderkey", VALUE)


@query("on_off_to_bool", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS pump FROM orders""")
def on_off_to_bool(spark, sf):
    word = F.when(F.col("o_orderstatus") == "O", "ON").when(F.col("o_orderstatus") == "F", "Off").otherwise("AUTO")
    df = table(spark, sf, "orders").select("o_orderkey", word.alias("pump"))
    return cleaning.on_off_to_bool(df, ["pump"])


@query("unit_conversions", """
    SELECT event_id, round(32 + 1.8 * value, 6) AS c_to_f, round(value / 3412, 9) AS btuhr_to_kw,
           round(value * 0.2641729, 9) AS l_to_g, round(32 + value / 10 * 9 / 5, 6) AS tenths_to_f,
           round((value - 32) * 5 / 9, 6) AS f_to_c, round(1.9438445 * value / 10, 10) AS knots,
           round(60 * 8.33 * value * 7 / 1000, 6) AS kbtuh, round(60 * 8.33 * value * 7 / 3412, 6) AS heat_kw,
           round(value * 60, 6) AS per_hour, round(value / (60 * 3.412), 9) AS kwh
    FROM events""")
def unit_conversions(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", *[F.col(VALUE).alias(n) for n in ("c_to_f", "btuhr_to_kw", "l_to_g")], VALUE)
    out = units.convert_columns(df, {"c_to_f": "c_to_f", "btuhr_to_kw": "btuhr_to_kw", "l_to_g": "l_to_g", "gone": "l_to_g"})
    v, seven = F.col(VALUE), F.lit(7)
    return out.select(
        "event_id", rounded("c_to_f").alias("c_to_f"), F.round("btuhr_to_kw", 9).alias("btuhr_to_kw"),
        F.round("l_to_g", 9).alias("l_to_g"), rounded(units.celsius_tenths_to_fahrenheit(v)).alias("tenths_to_f"),
        rounded(units.fahrenheit_to_celsius(v)).alias("f_to_c"), F.round(units.mps_tenths_to_knots(v), 10).alias("knots"),
        rounded(units.water_heat_kbtuh(v, seven)).alias("kbtuh"), rounded(units.water_heat_kw(v, seven)).alias("heat_kw"),
        rounded(units.per_minute_to_per_hour(v)).alias("per_hour"),
        F.round(units.btu_per_hour_to_kwh_per_minute(v), 9).alias("kwh"))


@query("sky_condition", "SELECT p_partkey, CASE p_size WHEN 8 THEN 'Eight oktas - 10/10, or OVC' WHEN 18 THEN 'Overcast' END AS sky FROM part WHERE p_size IN (8, 18) OR p_size > 19")
def sky_condition(spark, sf):
    df = table(spark, sf, "part").where("p_size IN (8, 18) OR p_size > 19")
    return df.select("p_partkey", units.sky_condition(F.col("p_size")).alias("sky"))


@query("merge_indexlike_rows", """
    SELECT o_custkey AS site, o_orderdate AS ts,
        arg_min(CASE WHEN o_totalprice > 200000 THEN o_totalprice END, o_orderkey)
            FILTER (WHERE o_totalprice > 200000) AS price,
        arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS state
    FROM orders GROUP BY 1, 2""")
def merge_indexlike_rows(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_custkey").alias(SITE), F.col("o_orderdate").alias(TS), F.col("o_orderkey").alias("ingest_seq"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("state"))
    return cleaning.merge_rows(df, ["price", "state"])


@query("first_text_per_moment", """
    SELECT CAST(o_custkey AS VARCHAR) AS site, o_orderdate AS ts, 'status' AS variable,
        arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS text
    FROM orders GROUP BY 1, 2""")
def first_text_per_moment(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(SITE), F.col("o_orderdate").alias(TS), F.lit("status").alias(VARIABLE),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("text"), F.col("o_orderkey").alias("ingest_seq"))
    return cleaning.first_text(df)


@query("replace_humidity", f"""
    WITH w AS ({WIDE_SQL})
    SELECT site, ts, round(CASE WHEN ts > TIMESTAMP '2024-01-15' THEN view ELSE click END, 6) AS Humidity_ODRH FROM w""")
def replace_humidity(spark, sf):
    wide = _wide(spark, sf)
    df = wide.select(SITE, TS, F.col("click").alias("Humidity_ODRH"))
    field = wide.select(SITE, TS, F.col("view").alias("reading"))
    out = cleaning.replace_humidity(df, field, "2024-01-15 00:00:00")
    return out.withColumn("Humidity_ODRH", rounded("Humidity_ODRH"))


@query("outdoor_conditions", f"""
    SELECT ts AS time_utc, round(click, 6) AS lab_ODT, round(view, 6) AS lab_ODRH FROM ({WIDE_SQL}) WHERE error > 0.01""")
def outdoor_conditions(spark, sf):
    df = _wide(spark, sf).select(
        F.col(TS).alias("time_utc"), F.col("click").alias("Temp_ODT"), F.col("view").alias("Humidity_ODRH"),
        F.col("error").alias("Power_OD_total1"))
    out = cleaning.outdoor_conditions(df, "lab")
    return out.select("time_utc", rounded("lab_ODT").alias("lab_ODT"), rounded("lab_ODRH").alias("lab_ODRH"))


@query("prepend_last_row", """
    SELECT o_orderkey, o_orderdate AS ts FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    UNION ALL
    SELECT o_orderkey, o_orderdate AS ts FROM orders WHERE o_orderkey = (
        SELECT arg_max(o_orderkey, (o_orderdate, o_orderkey)) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def prepend_last_row(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias(TS), "o_custkey")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    stored = latest(orders.where(F.col(TS) < cut).drop("o_custkey"), [])
    return cleaning.prepend_last_row(orders.where(F.col(TS) >= cut), stored)

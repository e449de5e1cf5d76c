"""Reader queries: file lines and payloads are made from `events` and parsed back."""

from pyspark.sql import DataFrame, functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import EVENT_TYPES, rounded, table
from wattloom.model import SITE, TS, VALUE, VARIABLE, literal_table
from wattloom.sources import files, logger_csv, payloads, weather

BASE = "SELECT user_id % 5 AS u, ts, date_trunc('second', ts) AS sec, event_type, value, event_id FROM events"
BOTH = f"""SELECT b.*, v.variable AS name, CASE WHEN event_type = v.variable THEN value END AS v
    FROM ({BASE}) b CROSS JOIN (VALUES {", ".join(f"('{t}')" for t in EVENT_TYPES)}) v(variable)"""
NAMES = ",".join(EVENT_TYPES)


def _stray(mark: str) -> str:
    """A line below the header with the header's mark inside a text; it has no time, so it is no reading."""
    return f'"A {mark} of reset",1,2,3,4,5'


def _base(spark, sf) -> DataFrame:
    return table(spark, sf, "events").withColumn("u", F.pmod("user_id", F.lit(5)))


def _fields():
    """A CSV field for each event type, all but one empty."""
    return F.concat_ws(",", *[F.when(F.col("event_type") == n, F.col(VALUE).cast("string")).otherwise("") for n in EVENT_TYPES])


def _lines(rows: DataFrame, *head: str) -> DataFrame:
    """Rows ``(file_name, value, pos)`` with head lines in front of each file."""
    listed = F.array(*[F.struct(F.lit(h).alias("value"), F.lit(i - len(head)).cast("bigint").alias("pos")) for i, h in enumerate(head)])
    heads = rows.select("file_name").distinct().select("file_name", F.explode(listed).alias("h")).select("file_name", "h.*")
    return heads.unionByName(rows.select("file_name", "value", F.col("pos").cast("bigint").alias("pos")))


def _file(spark, sf, name, line) -> DataFrame:
    return _base(spark, sf).select(name.alias("file_name"), line.alias("value"), F.col("event_id").alias("pos"))


def _name(before: str, after: str):
    return F.concat(F.lit(before), F.col("u").cast("string"), F.lit(after))


@query("csv_lines", f"SELECT 'lab' AS site, sec AS ts, name AS variable, v AS value FROM ({BOTH})")
def csv_lines(spark, sf):
    time = F.date_format(TS, "yyyy/MM/dd HH:mm:ss")
    lines = _file(spark, sf, _name("f", ".csv"), F.concat_ws(",", time, _fields()))
    return logger_csv.plain(_lines(lines, f"DateTime,{NAMES}", _stray("DateTime")), "lab")


@query("modbus_lines", f"""
    SELECT 'lab' AS site, date_trunc('minute', ts) AS ts, 'mb-00' || u || '_' || name || '_x' AS variable, round(avg(v), 6) AS value
    FROM ({BOTH}) GROUP BY ALL""")
def modbus_lines(spark, sf):
    time = F.date_format(TS, "yyyy-MM-dd HH:mm:ss")
    lines = _file(spark, sf, _name("mb-00", ".652939A5_1.log.csv"), F.concat_ws(",", time, _fields()))
    out = logger_csv.modbus(_lines(lines, '"time(UTC)",' + ",".join(f'"{n} x"' for n in EVENT_TYPES), _stray("time(UTC)")), "lab")
    return out.withColumn(VALUE, rounded(VALUE))


@query("dent_lines", f"""
    SELECT 'lab' AS site, date_trunc('minute', ts) AS ts, name AS variable, round(avg(v), 6) AS value FROM ({BOTH}) GROUP BY ALL""")
def dent_lines(spark, sf):
    parts = (F.col("event_id").cast("string"), F.date_format(TS, "M/d/yyyy"), F.date_format(TS, "HH:mm:ss"))
    lines = _file(spark, sf, _name("dent", ".csv"), F.concat_ws(",", *parts, _fields()))
    preamble = [*(f"setting {i},a,b,c,d" for i in range(11)), "Start,1/1/2024,00:00:00,7,8,9,10,11"]
    out = logger_csv.dent(_lines(lines, *preamble, f"no,day,clock,{NAMES}"), "lab")
    return out.withColumn(VALUE, rounded(VALUE))


@query("flow_lines", f"""
    SELECT 'lab' AS site, date_trunc('minute', ts) AS ts, name AS variable, round(avg(v), 6) AS value FROM ({BOTH}) GROUP BY ALL""")
def flow_lines(spark, sf):
    parts = [F.date_format(TS, p) for p in ("M", "d", "yyyy", "H", "m", "s")]
    lines = _file(spark, sf, _name("flow", ".csv"), F.concat_ws(",", *parts, _fields()))
    preamble = [*(f"meter,{i}" for i in range(5)), "1,2,2024,3,4,5,6,7,8,9,10"]
    out = logger_csv.flow(_lines(lines, *preamble, f"Month,Day,Year,Hour,Minute,Second,{NAMES}"), "lab")
    return out.withColumn(VALUE, rounded(VALUE))


LOCAL_MINUTE = "date_trunc('minute', timezone('US/Pacific', timezone('UTC', sec)))"


def _epoch_text():
    origin = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.floor((F.col(TS) - origin).cast("interval second").cast("decimal(20,6)")).cast("string")


@query("msa_lines", f"""
    SELECT 'lab' AS site, {LOCAL_MINUTE} AS ts, 'msa' || u || name || '_1' AS variable, round(avg(v), 6) AS value FROM ({BOTH}) GROUP BY ALL""")
def msa_lines(spark, sf):
    lines = _file(spark, sf, _name("msa", ".csv"), F.concat_ws(",", _epoch_text(), _fields()))
    out = logger_csv.msa(_lines(lines, "DateEpoch(secs),click*1," + ",".join(f"{n} 1" for n in EVENT_TYPES[1:]), _stray("DateEpoch(secs)")), "lab", device_prefix=True)
    return out.withColumn(VALUE, rounded(VALUE))


@query("egauge_lines", f"""
    SELECT site, ts, variable, round(a - lag(a) OVER (PARTITION BY variable ORDER BY ts), 6) AS value FROM (
        SELECT 'lab' AS site, {LOCAL_MINUTE} AS ts, 'eg' || u || '_' || name AS variable, avg(v) AS a FROM ({BOTH}) GROUP BY ALL)""")
def egauge_lines(spark, sf):
    lines = _file(spark, sf, _name("eg", ".csv"), F.concat_ws(",", _epoch_text(), _fields()))
    out = logger_csv.egauge(_lines(lines, f"Date & Time,{NAMES}", _stray("Date & Time")), "lab")
    return out.withColumn(VALUE, rounded(VALUE))


@query("small_planet_lines", f"""
    SELECT 'lab' AS site, {LOCAL_MINUTE} AS ts, 'Temp_Supply' AS variable, round(avg(v), 6) AS value
    FROM ({BOTH}) WHERE name = 'click' AND u < 2 GROUP BY ALL
    HAVING count(v) > 0""")
def small_planet_lines(spark, sf):
    """Two aliases share one true name."""
    rules = literal_table(spark, [("sp0click", "Temp_Supply"), ("sp1click", "Temp_Supply")], "variable_alias string, variable_name string")
    lines = _file(spark, sf, _name("sp", ".csv"), F.concat_ws(",", _epoch_text(), _fields()))
    out = logger_csv.small_planet(_lines(lines, f"DateEpoch(secs),{NAMES}", _stray("DateEpoch(secs)")), "lab", rules)
    return out.where("value IS NOT NULL").withColumn(VALUE, rounded(VALUE))


@query("nclarity_lines", f"""
    SELECT 'lab' AS site, sec AS ts, name AS variable, v AS value FROM ({BOTH})""")
def nclarity_lines(spark, sf):
    name = F.concat(F.lit("unit_"), F.date_format(TS, "yyyy-MM-dd"), F.lit("_log.csv"))
    lines = _file(spark, sf, name, F.concat_ws(",", F.date_format(TS, "HH:mm:ss"), _fields()))
    return logger_csv.nclarity(_lines(lines, f"time,{NAMES}", _stray("time")), "lab")


@query("aqsuite_registry", f"""
    SELECT 'lab' AS site, 'aq' || u || '.csv' AS file_name, min(sec) AS start_datetime, max(sec) AS end_datetime FROM ({BASE}) WHERE u <> 3 GROUP BY u
    UNION ALL SELECT 'lab', 'aq3.csv', TIMESTAMP '2023-01-01', TIMESTAMP '2023-02-01'""")
def aqsuite_registry(spark, sf):
    time = F.date_format(TS, "yyyy-MM-dd HH:mm:ss")
    lines = _file(spark, sf, _name("aq", ".csv"), F.concat_ws(",", time, _fields()))
    known = literal_table(spark, [("lab", "aq3.csv", "2023-01-01", "2023-02-01")], "site string, file_name string, start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    return files.update_registry(known, logger_csv.aqsuite(_lines(lines, f"time(UTC),{NAMES}", _stray("time(UTC)")), "lab"), "lab")


@query("file_name_hex_epoch", """
    SELECT event_id, date_trunc('second', ts) AS ts FROM events
    WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-05' AND date_trunc('second', ts) < TIMESTAMP '2024-01-20'""")
def file_name_hex_epoch(spark, sf):
    name = F.concat(F.lit("mb-022."), F.hex(_epoch_text().cast("bigint")), F.lit("_1.log.csv"))
    named = table(spark, sf, "events").select("event_id", files.name_hex_epoch(name).alias(TS))
    return named.where(files.within(F.col(TS), "2024-01-05 00:00:00", "2024-01-20 00:00:00", strict=True))


@query("file_name_date", """
    SELECT event_id, date_trunc('second', ts) AS ts FROM events
    WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-05' AND date_trunc('second', ts) < TIMESTAMP '2024-01-20'""")
def file_name_date(spark, sf):
    name = F.concat(F.lit("E45F012D4C0D_"), F.date_format(TS, "yyyyMMddHHmmss"), F.lit(".gz"))
    named = table(spark, sf, "events").select("event_id", files.name_date(name).alias(TS))
    return named.where(files.within(F.col(TS), "2024-01-05 00:00:00", "2024-01-20 00:00:00"))


@query("json_payload_to_readings", """
    SELECT 'site_' || CAST(user_id % 10 AS VARCHAR) AS site, ts, 'k' AS variable, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events""")
def json_payload_to_readings(spark, sf):
    df = table(spark, sf, "events").select(
        F.concat(F.lit("site_"), F.pmod("user_id", F.lit(10)).cast("string")).alias(SITE), TS,
        F.explode(F.from_json("props", "map<string, string>")).alias(VARIABLE, "text"))
    return df.select(SITE, TS, VARIABLE, payloads.number(F.col("text")).alias(VALUE))


@query("sensor_json", """
    SELECT site, CASE WHEN strftime(ts, '%M:%S') = '59:59' THEN ts + INTERVAL 1 SECOND ELSE ts END AS ts, variable, value FROM (
        SELECT 'lab' AS site, timezone('US/Pacific', timezone('UTC', date_trunc('second', ts))) AS ts, event_type AS variable, avg(value) AS value
        FROM events GROUP BY ALL)""")
def sensor_json(spark, sf):
    entry = F.struct(F.col("event_type").alias("id"), F.col(VALUE).alias("data"))
    df = table(spark, sf, "events").select(
        F.lit("lab").alias(SITE), F.date_format(TS, "yyyy/MM/dd HH:mm:ss").alias("time"), F.array(entry).alias("sensors"))
    return payloads.sensor_arrays(df, "US/Pacific")


SHARED = """SELECT 'lab' AS site, date_trunc('second', ts) AS ts, event_type AS variable, value FROM events"""


def _rows(spark, sf, payload):
    return table(spark, sf, "events").select(F.lit("lab").alias(SITE), payload.alias("payload"))


@query("thingsboard_payload", SHARED.replace(", value FROM", ", CASE WHEN user_id % 7 = 0 THEN NULL ELSE value END AS value FROM"))
def thingsboard_payload(spark, sf):
    text = F.when(F.col("user_id") % 7 == 0, "on").otherwise(F.col(VALUE).cast("string"))
    payload = F.concat(F.lit('{"'), "event_type", F.lit('":[{"ts":'), _epoch_text(), F.lit('000,"value":"'), text, F.lit('"}]}'))
    return payloads.thingsboard(_rows(spark, sf, payload))


@query("licor_payload", SHARED)
def licor_payload(spark, sf):
    record = F.concat(F.lit('{"records":[['), _epoch_text(), F.lit("000,"), F.col(VALUE).cast("string"), F.lit("]]}"))
    payload = F.concat(F.lit('{"sensors":[{"sensorSerialNumber":"'), "event_type", F.lit('","data":[{"records":[[0,1]]},'), record, F.lit("]}]}"))
    return payloads.licor(_rows(spark, sf, payload))


@query("field_manager_payload", "SELECT site, ts, variable, round(avg(value), 6) AS value FROM (" + SHARED + ") GROUP BY ALL")
def field_manager_payload(spark, sf):
    payload = F.concat(F.lit('{"data":{"dev":{"'), "event_type", F.lit('":[{"time":'), _epoch_text(), F.lit(',"value":'),
                       F.col(VALUE).cast("string"), F.lit("}]}}}"))
    return payloads.field_manager(_rows(spark, sf, payload)).withColumn(VALUE, rounded(VALUE))


@query("skycentrics_payload", """
    SELECT site, CASE WHEN strftime(ts, '%M:%S') = '59:59' THEN ts + INTERVAL 1 SECOND ELSE ts END AS ts, variable, value FROM (
        SELECT 'lab' AS site, timezone('US/Pacific', timezone('UTC', date_trunc('second', ts))) AS ts, event_type AS variable, avg(value) AS value
        FROM events GROUP BY ALL)""")
def skycentrics_payload(spark, sf):
    payload = F.concat(F.lit('{"time":"'), F.date_format(TS, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","sensors":[{"id":"'), "event_type",
                       F.lit('","data":'), F.col(VALUE).cast("string"), F.lit("}]}"))
    return payloads.skycentrics(_rows(spark, sf, payload))


@query("bluedot_payload", "SELECT 'lab' AS site, date_trunc('second', ts) AS ts, 'total_flow' AS variable, value FROM events")
def bluedot_payload(spark, sf):
    payload = F.concat(F.lit('[{"timestamp":'), _epoch_text(), F.lit(',"device_id":"d1","total":'), F.col(VALUE).cast("string"), F.lit("}]"))
    return payloads.bluedot(_rows(spark, sf, payload))


@query("station_weather", """
    WITH r AS (SELECT '727930-24234' AS station, event_id, date_trunc('hour', ts) AS h, CAST(round(value) AS INTEGER) AS v, CAST(user_id % 25 AS INTEGER) AS c FROM events)
    SELECT station, timezone('US/Pacific', timezone('UTC', h)) AS ts, round(32 + v / 10 * 9 / 5, 6) AS airTemp_F,
           round(1.9438445 * v / 10, 9) AS windSpeed_kts, CASE WHEN v % 2 = 0 THEN NULL ELSE CAST(v AS DOUBLE) END AS windDirection_deg,
           CASE c WHEN 18 THEN 'Overcast' ELSE CASE WHEN c > 19 THEN NULL ELSE 'other' END END AS sky, CASE WHEN v = 1 THEN 0.1 ELSE v / 10 END AS precip1Hour_mm
    FROM r""")
def station_weather(spark, sf):
    v = F.round(VALUE).cast("int").cast("string")
    direction = F.when(F.round(VALUE).cast("int") % 2 == 0, "-9999").otherwise(v)
    parts = (F.date_format(TS, "yyyy  MM dd HH"), v, v, F.lit("10130"), direction, v, F.pmod("user_id", F.lit(25)).cast("string"), v, F.lit("-9999"))
    lines = table(spark, sf, "events").select(F.lit("727930-24234-2024.gz").alias("file_name"), F.concat_ws("   ", *parts).alias("value"))
    out = weather.isd_lite(lines)
    sky = F.when(F.col("conditions") == "Overcast", "Overcast").when(F.col("conditions").isNotNull(), "other")
    return out.select("station", TS, rounded("airTemp_F").alias("airTemp_F"), rounded("windSpeed_kts", 9).alias("windSpeed_kts"),
                      "windDirection_deg", sky.alias("sky"), rounded("precip1Hour_mm").alias("precip1Hour_mm"))


@query("weather_choice", """
    SELECT 'kept' AS source, 's' || CAST(user_id % 3 AS VARCHAR) AS station, ts, value AS airTemp_F FROM events WHERE event_type = 'click'""")
def weather_choice(spark, sf):
    """Stations with fresh values keep their records."""
    shape = lambda kind, label: table(spark, sf, "events").where(F.col("event_type") == kind).select(
        F.lit(label).alias("source"), F.concat(F.lit("s"), F.pmod("user_id", F.lit(3)).cast("string")).alias("station"), TS,
        F.col(VALUE).alias("airTemp_F"))
    return weather.choose_weather(shape("click", "kept"), shape("view", "forecast"), "2024-01-31 00:00:00")


@query("station_ids", """
    SELECT 'K' || c_nationkey AS ICAO, arg_min(c_custkey || '-' || c_mktsegment, c_custkey) AS usaf_wban FROM customer GROUP BY 1""")
def station_ids(spark, sf):
    history = table(spark, sf, "customer").select(
        F.concat(F.lit("K"), "c_nationkey").alias("ICAO"), F.col("c_custkey").cast("string").alias("USAF"),
        F.col("c_mktsegment").alias("WBAN"), F.col("c_custkey").alias("seq"))
    return weather.station_ids(history)


@query("site_coordinates", """
    SELECT s.s_name AS site, CAST(s_nationkey * 2 AS VARCHAR) AS zip_code, CAST(n_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(n_nationkey * -2.5 AS DOUBLE) AS longitude
    FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey * 2""")
def site_coordinates(spark, sf):
    sites = table(spark, sf, "supplier").select(F.col("s_name").alias("site"), (F.col("s_nationkey") * 2).cast("string").alias("zip_code"))
    zips = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("zip"), (F.col("n_nationkey") * F.lit(1.5)).alias("latitude"), (F.col("n_nationkey") * F.lit(-2.5)).alias("longitude"))
    return weather.site_coordinates(sites, zips)

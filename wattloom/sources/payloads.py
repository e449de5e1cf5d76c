"""Landed JSON: logger files and API responses, to long readings.

A parser takes rows with a ``payload`` text column (one response per row) and gives
``(site, ts, variable, value)``; values that are no number become NULL.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.functions.times import convert_zone, from_epoch
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.sources.files import parse_time

SENSOR_FILE = "device string, connection string, time string, sensors array<struct<id: string, data: double>>"
THINGSBOARD = "map<string, array<struct<ts: bigint, value: string>>>"
LICOR = "sensors array<struct<sensorSerialNumber: string, data: array<struct<records: array<array<string>>>>>>"
FIELD_MANAGER = "data map<string, map<string, array<struct<time: bigint, value: double>>>>"
SKYCENTRICS = "time string, sensors array<struct<id: string, data: double>>"
BLUEDOT = "array<struct<timestamp: bigint, device_id: string, total: double>>"


def number(text: Column) -> Column:
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def _rows(df: DataFrame, ts: Column, variable: Column, value: Column) -> DataFrame:
    return df.select(SITE, ts.alias(TS), variable.alias(VARIABLE), value.alias(VALUE))


def _mean(df: DataFrame) -> DataFrame:
    return df.groupBy(SITE, TS, VARIABLE).agg(F.avg(VALUE).alias(VALUE))


def _whole_hour(ts: Column) -> Column:
    """A reading stamped one second before the hour belongs to the hour."""
    late = (F.minute(ts) == 59) & (F.second(ts) == 59)
    return F.when(late, ts + F.expr("INTERVAL '1' SECOND")).otherwise(ts)


def sensor_arrays(df: DataFrame, zone: str) -> DataFrame:
    """Rows ``(site, time, sensors[id, data])`` with UTC times: the mean per id and time, then the hour rule."""
    local = convert_zone(parse_time(F.regexp_replace("time", "[TZ]", " ")), "UTC", zone)
    rows = df.select(SITE, local.alias(TS), F.explode("sensors").alias("s")).where("ts IS NOT NULL")
    return _mean(_rows(rows, F.col(TS), F.col("s.id"), F.col("s.data"))).withColumn(TS, _whole_hour(F.col(TS)))


def read_sensor_files(spark: SparkSession, path, site: str, zone: str = "US/Pacific", suffix: str = ".gz", prefix: str = "",
                      keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Logger JSON files, each an array of measurements; gzip is read natively, invalid files are skipped.

    ``keep`` tells from the file name whether a file is wanted.
    """
    raw = spark.read.schema(SENSOR_FILE).option("multiLine", "true").option("mode", "PERMISSIVE").option(
        "pathGlobFilter", f"{prefix}*{suffix}").json(path)
    wanted = raw if keep is None else raw.where(keep(F.col("_metadata.file_name")))
    return sensor_arrays(wanted.withColumn(SITE, F.lit(site)), zone)


def thingsboard(df: DataFrame) -> DataFrame:
    entries = df.select(SITE, F.explode(F.from_json("payload", THINGSBOARD)).alias("key", "records"))
    rows = entries.select(SITE, "key", F.explode("records").alias("r"))
    return _rows(rows, from_epoch(F.col("r.ts") / 1000), F.col("key"), number(F.col("r.value")))


def licor(df: DataFrame) -> DataFrame:
    """Of several measurements of a sensor the last one counts."""
    sensors = df.select(SITE, F.explode(F.from_json("payload", LICOR).getField("sensors")).alias("s"))
    records = sensors.select(SITE, F.col("s.sensorSerialNumber").alias("id"), F.explode(F.try_element_at("s.data", F.lit(-1)).getField("records")).alias("r"))
    return _rows(records, from_epoch(F.col("r")[0].try_cast("double") / 1000), F.col("id"), number(F.col("r")[1]))


def field_manager(df: DataFrame) -> DataFrame:
    devices = df.select(SITE, F.explode(F.from_json("payload", FIELD_MANAGER).getField("data")).alias("device", "sensors"))
    sensors = devices.select(SITE, F.explode("sensors").alias("id", "records"))
    rows = sensors.select(SITE, "id", F.explode("records").alias("r"))
    return _mean(_rows(rows, from_epoch(F.col("r.time")), F.col("id"), F.col("r.value")))


def skycentrics(df: DataFrame, zone: str = "US/Pacific") -> DataFrame:
    parsed = df.select(SITE, F.explode(F.from_json("payload", f"array<struct<{_struct(SKYCENTRICS)}>>")).alias("p"))
    return sensor_arrays(parsed.select(SITE, "p.time", "p.sensors"), zone)


def _struct(ddl: str) -> str:
    """Top-level ``name type`` fields in the ``name: type`` form that a nested struct needs."""
    return ddl.replace("time string", "time: string").replace("sensors array", "sensors: array")


def bluedot(df: DataFrame) -> DataFrame:
    rows = df.select(SITE, F.explode(F.from_json("payload", BLUEDOT)).alias("r"))
    return _rows(rows, from_epoch(F.col("r.timestamp")), F.lit("total_flow"), F.col("r.total"))


PARSERS: dict[str, Callable[..., DataFrame]] = {
    "api_tb": thingsboard, "api_licor": licor, "api_fm": field_manager, "api_skycentrics": skycentrics, "api_bluedot": bluedot,
}


def read_payloads(spark: SparkSession, path, site: str, suffix: str = ".json") -> DataFrame:
    """Landed responses, one file each."""
    raw = spark.read.option("wholetext", "true").option("pathGlobFilter", f"*{suffix}").option("ignoreCorruptFiles", "true").text(path)
    return raw.select(F.lit(site).alias(SITE), F.col("value").alias("payload"))

"""Weather: hourly station files, landed forecast tables, and the choice between them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions import units
from wattloom.functions.times import convert_zone, step
from wattloom.model import known

# Columns of the station files, their missing marker, and the age limit.
ISD_COLUMNS = ("year", "month", "day", "hour", "airTemp", "dewPoint", "seaLevelPressure", "windDirection", "windSpeed",
               "conditions", "precip1Hour", "precip6Hour")
ISD_MISSING = -9999
STATION_ZONE = "US/Pacific"
FRESH_DAYS = 7
WEATHER = ("airTemp_F", "dewPoint_F", "seaLevelPressure_mb", "windDirection_deg", "windSpeed_kts", "conditions",
           "precip1Hour_mm", "precip6Hour_mm")


def isd_lite(lines: DataFrame, zone: str = STATION_ZONE) -> DataFrame:
    """Lines ``(file_name, value)`` of station files to hourly weather per station.

    The station id is the file name up to its last dash.
    """
    fields = F.split(F.trim("value"), r"\s+")
    parsed = lines.select(
        F.regexp_extract("file_name", r"^(.*)-[^-]*$", 1).alias("station"),
        *[F.try_element_at(fields, F.lit(i + 1)).try_cast("int").alias(n) for i, n in enumerate(ISD_COLUMNS)])
    v = lambda n: F.when(F.col(n) != ISD_MISSING, F.col(n))
    whole = F.format_string("%04d-%02d-%02d %02d:00:00", "year", "month", "day", "hour").try_cast("timestamp_ntz")
    return parsed.select(
        "station", convert_zone(F.when(F.col("hour").isNotNull(), whole), "UTC", zone).alias("ts"),
        units.celsius_tenths_to_fahrenheit(v("airTemp")).alias("airTemp_F"),
        units.celsius_tenths_to_fahrenheit(v("dewPoint")).alias("dewPoint_F"),
        units.tenth(v("seaLevelPressure")).alias("seaLevelPressure_mb"), v("windDirection").cast("double").alias("windDirection_deg"),
        units.mps_tenths_to_knots(v("windSpeed")).alias("windSpeed_kts"), units.sky_condition(v("conditions")).alias("conditions"),
        units.precipitation_tenths(v("precip1Hour")).alias("precip1Hour_mm"),
        units.precipitation_tenths(v("precip6Hour")).alias("precip6Hour_mm")).where("ts IS NOT NULL")


def read_isd_lite(spark: SparkSession, path, zone: str = STATION_ZONE) -> DataFrame:
    lines = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").text(path)
    return isd_lite(lines.select(F.col("_metadata.file_name").alias("file_name"), "value"), zone)


def forecast_hours(df: DataFrame, zone: str) -> DataFrame:
    """Landed hourly temperatures ``(station, ts, temperature_2m)`` in UTC to the station form."""
    return df.select("station", convert_zone(F.col("ts"), "UTC", zone).alias("ts"),
                     known(F.col("temperature_2m")).alias("airTemp_F"), F.lit(None).cast("double").alias("dewPoint_F"))


def station_ids(history: DataFrame, seq: str = "seq") -> DataFrame:
    """``USAF-WBAN`` of each ICAO code; the first entry wins."""
    return history.groupBy("ICAO").agg(F.min_by(F.concat_ws("-", "USAF", "WBAN"), seq).alias("usaf_wban"))


def site_coordinates(sites: DataFrame, zips: DataFrame) -> DataFrame:
    """Site to zip code to coordinates; ``zips`` is ``(zip, latitude, longitude)``."""
    return sites.withColumn("zip", F.col("zip_code").try_cast("int")).join(zips, "zip", "left").select(
        "site", "zip_code", "latitude", "longitude")


def choose_weather(stations: DataFrame, forecast: DataFrame, now: str) -> DataFrame:
    """Station records if any station has a value in the last week, else the forecast for all stations.

    The test is a filter on time that stops at the first row.
    """
    known_value = F.lit(False)
    for name in WEATHER:
        if name in stations.columns:
            known_value = known_value | F.col(name).isNotNull()
    recent = F.col("ts") >= F.lit(now).cast("timestamp_ntz") - step("DAY", FRESH_DAYS)
    return forecast if stations.where(recent & known_value).isEmpty() else stations

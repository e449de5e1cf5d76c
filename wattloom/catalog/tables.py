"""How the given tables are read as sensor data, in Spark and in SQL."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str, sites: int = 10) -> DataFrame:
    """Each event is a reading: the site from its user, the variable from its type."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("site_"), F.pmod("user_id", F.lit(sites)).cast("string")).alias(SITE),
        TS, F.col("event_type").alias(VARIABLE), VALUE)


def readings_sql(sites: int = 10) -> str:
    return (f"SELECT 'site_' || CAST(user_id % {sites} AS VARCHAR) AS site, ts, "
            "event_type AS variable, value FROM events")


def grain_readings(spark: SparkSession, sf: str, grain: str = "HOUR", sites: int = 10) -> DataFrame:
    """One mean reading per slot; the raw rows are pre-aggregated before any window."""
    return readings(spark, sf, sites).groupBy(SITE, VARIABLE, floor_time(F.col(TS), grain).alias(TS)).agg(
        F.avg(VALUE).alias(VALUE))


def grain_sql(grain: str = "hour", sites: int = 10) -> str:
    return (f"SELECT site, variable, date_trunc('{grain}', ts) AS ts, avg(value) AS value "
            f"FROM ({readings_sql(sites)}) GROUP BY 1, 2, 3")


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)

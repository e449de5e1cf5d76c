"""Equality joins of prepared tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS

#: Parts that the rows of a key are dealt into where keys are few.
PARTS = 32


def join_few(df: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner", parts: int = PARTS) -> DataFrame:
    """Join with a table whose keys may be a handful, such as one row per file or site.

    A shuffle by a few keys leaves all rows in as many tasks, also where Spark broadcasts in the end, as it then keeps the number of
    tasks. Rows of a key are dealt into ``parts`` in turn, and each row of ``few`` is repeated for every part. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a row of the few side would repeat in a {how} join")
    dealt = df.withColumn("_part", (F.monotonically_increasing_id() % parts).cast("int"))
    repeated = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")


def join_weather(hours: DataFrame, weather: DataFrame, oat: str = "OAT_NOAA") -> DataFrame:
    """Left join of hourly rows with weather; skipped when the temperature is never known.

    The test reads one row at most.
    """
    if oat in weather.columns and weather.where(F.col(oat).isNotNull()).isEmpty():
        return hours
    return hours.join(weather, [SITE, TS], "left")


def join_daily(days: DataFrame, cop: DataFrame) -> DataFrame:
    return days.join(cop, [SITE, TS], "left")


def daily_weather(hours: DataFrame, oat: str = "OAT_NOAA") -> DataFrame:
    return hours.groupBy(SITE, floor_time(F.col(TS), "DAY").alias(TS)).agg(F.avg(oat).alias(oat))


def unseen(listed: DataFrame, registry: DataFrame, key: str = "file") -> DataFrame:
    """Files that the registry table does not know."""
    return listed.join(registry, key, "left_anti")

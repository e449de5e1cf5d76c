"""The four steps of a run.

Reading and the last two steps are lazy. The transform settles the cleaned minutes and the days with a
checkpoint, as hours, days, statistics, every alarm shape and the stored tables all read them.
"""

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.operators import aggregates, alarms, cleaning, filling
from wattloom.session import cut_lineage
from wattloom.sinks.upsert import store_all
from wattloom.sources import marks
from wattloom.sources.dispatch import read_raw

PreHook = Callable[[DataFrame], DataFrame]
PostHook = Callable[[DataFrame, DataFrame, DataFrame], tuple[DataFrame, DataFrame, DataFrame]]


class Tables(NamedTuple):
    """Results of the transform. States and flags exist when a schedule was given."""

    minute: DataFrame
    hour: DataFrame
    day: DataFrame
    hour_state: DataFrame | None = None
    day_flag: DataFrame | None = None


def extract(
    spark: SparkSession, kind: str, path, site: str, *, stored: DataFrame | None = None, reprocess: bool = False, **options,
) -> DataFrame:
    """Landed readings of a site since its last full stored day.

    Files whose name is dated before the day of that mark are not read; rows up to the mark are dropped from the others.
    With ``reprocess`` the stored history up to that day is put in front of what was read.
    """
    if stored is None:
        return read_raw(spark, kind, path, site, **options)
    sites = spark.sql("SELECT :site AS site", args={"site": site})
    mark = marks.last_full_day(stored.where(F.col(SITE) == site), sites)
    # one row: the mark of this site
    day = mark.select(F.to_date("mark")).first()[0]
    raw = read_raw(spark, kind, path, site, **{"start": f"{day} 00:00:00", "keep_undated": True} | options)
    fresh = raw.join(mark, SITE).where(F.col(TS) > F.col("mark")).drop("mark")
    return marks.merge_history(stored.where(F.col(SITE) == site), fresh, mark) if reprocess else fresh


def transform(
    raw: DataFrame,
    rules: DataFrame,
    *,
    system: str | None = None,
    seq: str | None = None,
    seed: DataFrame | None = None,
    zone_from: str = "America/Los_Angeles",
    zone_to: str = "America/Los_Angeles",
    schedule: DataFrame | None = None,
    weather: DataFrame | None = None,
    oat: str = "Temp_OAT",
    hour_threshold: float = 0.8,
    day_threshold: float = 1.0,
    remove_partial: bool = True,
    exempt: Sequence[str] = (),
    settle: bool = True,
    pre_aggregation: PreHook | None = None,
    post_aggregation: PostHook | None = None,
) -> Tables:
    """Rename, floor, fill, shift zone, average duplicates, then hours and days with weather.

    Every raw row of a site is a moment of each of its variables, as in a wide frame, so a gap in one device's file is filled at the
    times of another's; no row is made for it before minutes are. ``seq`` tells raw rows of one time apart.
    Filling comes before duplicates are averaged, so a fill limit counts duplicate rows. ``exempt`` variables are never
    emptied for having too few values. ``weather``
    is ``(site, ts, <oat>, ...)``; its columns join the hours as variables. ``settle=False`` leaves
    the minutes and days as plans, for callers that store them before reading on; hours are then summed without making minutes.
    """
    rules = cleaning.rules_for(rules, system=system)
    named = cleaning.floor_to(cleaning.rename_by_rules(raw, rules), "MINUTE")
    fill = rules.select(*([SITE] if SITE in rules.columns else []), "variable_name", "changepoint", "ffill_length").distinct()
    filled = filling.fill(named, fill, seq=seq, seed=seed)
    minute = filling.minutes(filled)
    changed = zone_from != zone_to or pre_aggregation is not None
    if zone_from != zone_to:  # two hours can become one
        minute = cleaning.average_duplicates(cleaning.shift_zone(minute, zone_from, zone_to))
    if pre_aggregation is not None:
        minute = pre_aggregation(minute)
        if not isinstance(minute, DataFrame):
            raise TypeError("pre_aggregation must return a DataFrame")
    if settle:
        minute = cut_lineage(minute)
    parts = aggregates.hour_parts(minute) if settle or changed else filling.hour_parts(filled)
    hour, day = aggregates.of_parts(parts, hour_threshold, day_threshold, remove_partial, exclude=exempt)
    states = flags = None
    if schedule is not None:
        states = aggregates.load_shift_state(hour.select(SITE, TS).distinct(), schedule)
        flags = aggregates.load_shift_days(day.select(SITE, TS).distinct(), schedule)
    if weather is not None:
        hour, day = with_weather(hour, day, weather, oat)
    if post_aggregation is not None:
        result = post_aggregation(minute, hour, day)
        if not (isinstance(result, tuple) and len(result) == 3 and all(isinstance(d, DataFrame) for d in result)):
            raise TypeError("post_aggregation must return three DataFrames: minute, hour, day")
        minute, hour, day = result
    if settle:
        day = cut_lineage(day)
    return Tables(minute, hour, day, states, flags)


def with_weather(hour: DataFrame, day: DataFrame, weather: DataFrame, oat: str) -> tuple[DataFrame, DataFrame]:
    """Add weather columns as variables to the hours that exist, and the daily mean temperature.

    Nothing is added when the temperature is never known; that test reads one row at most.
    """
    if oat in weather.columns and weather.where(F.col(oat).isNotNull()).isEmpty():
        return hour, day
    names = [n for n, t in weather.dtypes if t in ("double", "float") and n not in (SITE, TS)]
    long = weather.select(SITE, TS, *names).unpivot([SITE, TS], names, VARIABLE, VALUE)
    known_hours = hour.select(SITE, TS).distinct()
    joined = known_hours.join(long, [SITE, TS]).select(SITE, VARIABLE, TS, F.col(VALUE).cast("double").alias(VALUE))
    daily = joined.where(F.col(VARIABLE) == oat).groupBy(SITE, VARIABLE, floor_time(F.col(TS), "DAY").alias(TS)).agg(
        F.avg(VALUE).alias(VALUE))
    known_days = day.select(SITE, TS).distinct()
    return hour.unionByName(joined), day.unionByName(daily.join(known_days, [SITE, TS], "left_semi"))


def find_alarms(tables: Tables, rules: DataFrame, schedule: DataFrame | None = None, *, stored_days: DataFrame | None = None,
                system: str | None = None, days: int = 7) -> DataFrame:
    return alarms.all_alarms(tables.minute, tables.day, rules, schedule, stored=stored_days, days=days, system=system)


def load(tables: Tables, base: str, alarm_table: DataFrame | None = None, statistics: DataFrame | None = None,
         events: DataFrame | None = None, data_loss: bool = False, now: Column | None = None) -> None:
    """Store alarms first, then events and data losses, then minute, hour and day tables."""
    store_all(base, minute=tables.minute, hour=tables.hour, day=tables.day, statistics=statistics, alarms=alarm_table, events=events,
              data_loss=data_loss, now=now)

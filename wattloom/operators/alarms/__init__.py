"""Equipment alarms: single detectors and the run of all of them.

A detector is a function ``(minute, daily, rules, ...) -> alarms``; :data:`DETECTORS` may be extended.
"""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from wattloom.operators.alarms import detectors as d, text
from wattloom.operators.cleaning import rules_for
from wattloom.operators.intervals import merge_alarms


def _rules(rules: DataFrame, system: str | None) -> DataFrame:
    return rules_for(rules, system=system)


def flag_boundary(minute, daily, rules, rows: int = 15, system=None, grain="MINUTE") -> DataFrame:
    return merge_alarms(d.value_streaks(minute, d.boundary_rules(_rules(rules, system), rows), grain))


def _value(minute, daily, value_rules, grain) -> DataFrame:
    return d.on_days_of(d.value_streaks(minute, value_rules, grain), daily)


def flag_temp_range(minute, daily, rules, low=115, high=130, rows=10, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.TEMP_RANGE, temp_low=low, temp_high=high)
    return merge_alarms(_value(minute, daily, d.temp_range_rules(book, rows), grain))


def flag_blown_fuse(minute, daily, rules, threshold=1.0, margin=2.0, draw=30, rows=3, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.BLOWN_FUSE, fuse_draw=draw)
    return merge_alarms(_value(minute, daily, d.blown_fuse_rules(book, threshold, margin, rows), grain))


def _pair(minute, daily, pairs, grain, warmup: int = 10) -> DataFrame:
    return d.on_days_of(d.pair_streaks(minute, pairs, grain, warmup), daily)


def flag_inlet_temp(minute, daily, rules, power=1.0, temp=115.0, rows=5, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.INLET, inlet_power=power, inlet_temp=temp)
    return merge_alarms(_pair(minute, daily, d.pair_rules(book, text.INLET, rows), grain))


def flag_outlet_temp(minute, daily, rules, power=1.0, temp=140.0, rows=5, warmup=10, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.OUTLET, outlet_power=power, outlet_temp=temp)
    return merge_alarms(_pair(minute, daily, d.pair_rules(book, text.OUTLET, rows), grain, warmup))


def flag_tm_setpoint(minute, daily, rules, rows=3, setpoint=130.0, power=1.0, share=0.4, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.TM_SETPOINT, tm_setpoint=setpoint, tm_power=power, tm_share=share)
    altered = _value(minute, daily, d.setpoint_rules(book, text.TM_SETPOINT), grain)
    draw = _pair(minute, daily, d.pair_rules(book, text.TM_SETPOINT, rows), grain)
    shares = d.daily_shares(daily, d.share_rules(book, text.TM_SETPOINT), grain)
    return merge_alarms(_union([altered, draw, shares]))


def flag_backup_use(minute, daily, rules, setpoint=130.0, share=0.1, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.BACKUP, backup_setpoint=setpoint, backup_share=share)
    altered = _value(minute, daily, d.setpoint_rules(book, text.BACKUP), grain)
    return merge_alarms(altered.unionByName(d.daily_shares(daily, d.share_rules(book, text.BACKUP), grain)))


def flag_balancing_valve(minute, daily, rules, share=0.4, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.BALANCING, balancing_share=share)
    return merge_alarms(d.daily_shares(daily, d.share_rules(book, text.BALANCING), grain))


def flag_abnormal_cop(minute, daily, rules, low=0.0, high=4.5, system=None, grain="MINUTE") -> DataFrame:
    return merge_alarms(d.abnormal_cop(daily, d.book(_rules(rules, system), text.ABNORMAL_COP, cop_low=low, cop_high=high)))


def flag_power_ratio(minute, daily, rules, days=7, stored=None, system=None, grain="MINUTE") -> DataFrame:
    return merge_alarms(d.power_ratio(daily, d.book(_rules(rules, system), text.POWER_RATIO), days, stored))


def flag_outage(minute, daily, rules, share=0.3, days=7, stored=None, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.OUTAGE, outage_share=share)
    flags = _value(minute, daily, d.outage_flag_rules(book), grain)
    return merge_alarms(flags.unionByName(d.outage_by_share(daily, book, flags, days, stored)))


def flag_soo_change(minute, daily, rules, schedule, power=1.0, on_temp=115.0, off_temp=140.0, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.SOO_CHANGE, change_power=power, on_temp=on_temp, off_temp=off_temp)
    return merge_alarms(d.on_days_of(d.soo_change(minute, book, schedule, grain=grain), daily))


def flag_short_cycle(minute, daily, rules, threshold=1.0, rows=15, system=None, grain="MINUTE") -> DataFrame:
    return merge_alarms(d.short_cycle(minute, d.book(_rules(rules, system), text.SHORT_CYCLE, cycle_power=threshold), rows, grain))


def flag_schedule_mismatch(minute, daily, rules, schedule, system=None, grain="MINUTE") -> DataFrame:
    book = d.book(_rules(rules, system), text.SOO_SCHEDULE)
    return merge_alarms(d.on_days_of(d.schedule_mismatch(minute, book, schedule, grain), daily))


Detector = Callable[..., DataFrame]
DETECTORS: dict[str, Detector] = {
    text.BOUNDARY: flag_boundary,
    text.TEMP_RANGE: flag_temp_range,
    text.BLOWN_FUSE: flag_blown_fuse,
    text.INLET: flag_inlet_temp,
    text.OUTLET: flag_outlet_temp,
    text.TM_SETPOINT: flag_tm_setpoint,
    text.BACKUP: flag_backup_use,
    text.BALANCING: flag_balancing_valve,
    text.ABNORMAL_COP: flag_abnormal_cop,
    text.POWER_RATIO: flag_power_ratio,
    text.OUTAGE: flag_outage,
    text.SOO_CHANGE: flag_soo_change,
    text.SHORT_CYCLE: flag_short_cycle,
    text.SOO_SCHEDULE: flag_schedule_mismatch,
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def all_alarms(minute: DataFrame, daily: DataFrame, rules: DataFrame, schedule: DataFrame | None = None, *,
               stored: DataFrame | None = None, days: int = 7, system: str | None = None, grain: str = "MINUTE",
               extra: Sequence[Detector] = ()) -> DataFrame:
    """Every detector over one site table.

    The rules of all tags are read, checked and settled once. Detectors of one shape run together: single-variable streaks in one pass
    over the readings, power-temperature pairs in another, daily shares in one daily aggregate. Nothing firing gives an empty table with
    the alarm columns.
    """
    rules = _rules(rules, system)
    book = d.book(rules, *(t for t in d.TAGS if schedule is not None or t not in (text.SOO_CHANGE, text.SOO_SCHEDULE)))
    value_rules = [
        d.temp_range_rules(book), d.blown_fuse_rules(book), d.setpoint_rules(book, text.TM_SETPOINT),
        d.setpoint_rules(book, text.BACKUP), d.outage_flag_rules(book)]
    streaks = _value(minute, daily, _union(value_rules), grain)
    pairs = [d.pair_rules(book, tag, rows) for tag, rows in ((text.INLET, 5), (text.OUTLET, 5), (text.TM_SETPOINT, 3))]
    frames = [
        streaks,
        _pair(minute, daily, _union(pairs), grain),
        d.daily_shares(daily, d.share_rules(book, text.TM_SETPOINT, text.BACKUP, text.BALANCING), grain),
        d.abnormal_cop(daily, book),
        d.power_ratio(daily, book, days, stored),
        d.outage_by_share(daily, book, streaks.where(streaks.alarm_type == text.OUTAGE), days, stored),
        d.short_cycle(minute, book, grain=grain),
    ]
    if {"low_alarm", "high_alarm"} <= set(rules.columns):
        frames.append(d.value_streaks(minute, d.boundary_rules(rules), grain))
    if schedule is not None:
        frames.append(d.on_days_of(d.soo_change(minute, book, schedule, grain=grain), daily))
        frames.append(d.on_days_of(d.schedule_mismatch(minute, book, schedule, grain), daily))
    frames += [detector(minute, daily, rules) for detector in extra]
    return merge_alarms(_union(frames))

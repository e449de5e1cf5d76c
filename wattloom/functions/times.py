"""Time helpers that stay in TIMESTAMP_NTZ, so no session zone can move a reading."""

from pyspark.sql import Column, functions as F

STEP = {"MINUTE": "INTERVAL '1' MINUTE", "HOUR": "INTERVAL '1' HOUR", "DAY": "INTERVAL '1' DAY"}


def floor_time(ts: Column, grain: str) -> Column:
    grain = grain.upper()
    day = F.to_date(ts).cast("timestamp_ntz")
    if grain == "DAY":
        return day
    if grain == "HOUR":
        return day + F.make_dt_interval(F.lit(0), F.hour(ts))
    if grain == "MINUTE":
        return day + F.make_dt_interval(F.lit(0), F.hour(ts), F.minute(ts))
    raise ValueError(f"unknown grain {grain!r}; expected one of {sorted(STEP)}")


def step(grain: str, count: int = 1) -> Column:
    grain = grain.upper()
    if grain not in STEP:
        raise ValueError(f"unknown grain {grain!r}; expected one of {sorted(STEP)}")
    return F.expr(f"INTERVAL '{count}' {grain}")


def steps(grain: str, count: Column) -> Column:
    """An interval of ``count`` grains, where the count is a column."""
    zero = F.lit(0)
    args = {"DAY": [count], "HOUR": [zero, count], "MINUTE": [zero, zero, count]}
    return F.make_dt_interval(*args[grain.upper()])


def convert_zone(ts: Column, source: str | Column, target: str | Column) -> Column:
    """Naive local time in ``source`` to naive local time in ``target``."""
    as_col = lambda zone: F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(as_col(source), as_col(target), ts)


def from_epoch(seconds: Column, target: str = "UTC") -> Column:
    """Naive time in ``target`` for Unix seconds, independent of the session zone."""
    micros = (seconds.cast("double") * 1_000_000).cast("bigint")
    naive = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros / 1_000_000).cast("decimal(18,6)")
    )
    return naive if target == "UTC" else convert_zone(naive, "UTC", target)

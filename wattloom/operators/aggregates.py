"""Time aggregation, completeness, load-shift labels and gap statistics."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.times import floor_time, step
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.operators.intervals import label
from wattloom.operators.sequences import streaks

# Which names are summed and which have no aggregate.
ENERGY = ".*Energy.*"
ENERGY_NOT_SUMMED = ".*EnergyRate.*|.*BTU$"
MINUTES_PER_HOUR, HOURS_PER_DAY = 60, 24


def is_energy(variable: Column) -> Column:
    return variable.rlike(ENERGY) & ~variable.rlike(ENERGY_NOT_SUMMED)


def has_aggregate(variable: Column) -> Column:
    return ~variable.rlike(ENERGY) | is_energy(variable)


def hour_parts(df: DataFrame, rate: str = "drop", mean_only: bool = False) -> DataFrame:
    """Sum, value count and row count per (site, variable, hour).

    The only shuffle of readings. Hours and days are both derived from these parts, and partial
    aggregation keeps a hot series from landing in one task row by row.
    """
    if rate not in ("drop", "mean"):
        raise ValueError("rate must be 'drop' or 'mean'")
    kept = df if rate == "mean" or mean_only else df.where(has_aggregate(F.col(VARIABLE)))
    return kept.groupBy(SITE, VARIABLE, floor_time(F.col(TS), "HOUR").alias("hour")).agg(
        F.sum(VALUE).alias("_sum"), F.count(VALUE).alias("_values"), F.count(F.lit(1)).alias("_rows"))


def _value(mean_only: bool) -> Column:
    mean = F.col("_sum") / F.when(F.col("_values") > 0, F.col("_values"))
    if mean_only:
        return mean
    return F.when(is_energy(F.col(VARIABLE)), F.coalesce(F.col("_sum"), F.lit(0.0))).otherwise(mean)


def hourly(parts: DataFrame, mean_only: bool = False) -> DataFrame:
    return parts.select(SITE, VARIABLE, F.col("hour").alias(TS), _value(mean_only).alias(VALUE), "_values", "_rows")


def daily(parts: DataFrame, mean_only: bool = False) -> DataFrame:
    rolled = parts.groupBy(SITE, VARIABLE, floor_time(F.col("hour"), "DAY").alias(TS)).agg(
        F.sum("_sum").alias("_sum"), F.sum("_values").alias("_values"))
    return rolled.select(SITE, VARIABLE, TS, _value(mean_only).alias(VALUE))


def aggregate(df: DataFrame, grain: str = "HOUR", rate: str = "drop", dense: bool = False,
              mean_only: bool = False) -> DataFrame:
    """Hourly or daily values: energy summed (0 when all is missing), the rest averaged."""
    parts = hour_parts(df, rate, mean_only)
    out = hourly(parts, mean_only).drop("_values", "_rows") if grain.upper() == "HOUR" else daily(parts, mean_only)
    return densify(out, grain, mean_only) if dense else out


def densify(df: DataFrame, grain: str, mean_only: bool = False) -> DataFrame:
    """Every bucket between a site's first and last one, for each of its variables."""
    variables = df.select(SITE, VARIABLE).distinct()
    span = df.groupBy(SITE).agg(F.min(TS).alias("_lo"), F.max(TS).alias("_hi"))
    grid = variables.join(
        span.select(SITE, F.explode(F.sequence("_lo", "_hi", step(grain))).alias(TS)), SITE)
    joined = grid.join(df, [SITE, VARIABLE, TS], "left")
    if mean_only:
        return joined.select(SITE, VARIABLE, TS, VALUE)
    empty = F.when(is_energy(F.col(VARIABLE)), F.coalesce(F.col(VALUE), F.lit(0.0))).otherwise(F.col(VALUE))
    return joined.select(SITE, VARIABLE, TS, empty.alias(VALUE))


def _check(name: str, share: float) -> None:
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"{name} must be between 0 and 1, e.g. 0.8 for 80%")


def _exempt(exclude: Sequence[str]) -> Column:
    return F.col(VARIABLE).isin(list(exclude)) if exclude else F.lit(False)


def complete_hours(parts: DataFrame, threshold: float = 0.8, mean_only: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop hours with too few rows; empty a variable with too few values in an hour that stays, unless it is in ``exclude``.

    Readings must have a row per variable and moment (``model.complete_rows``), as wide rows do, so
    the row count of a variable is the row count of its site.
    """
    _check("complete_hour_threshold", threshold)
    need = MINUTES_PER_HOUR * threshold
    value = F.when((F.col("_values") >= need) | _exempt(exclude), F.col(VALUE))
    return hourly(parts, mean_only).where(F.col("_rows") >= need).select(SITE, VARIABLE, TS, value.alias(VALUE))


def complete_days(parts: DataFrame, hour_threshold: float = 0.8, day_threshold: float = 1.0,
                  mean_only: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop days with too few complete hours; empty a variable with too few hourly values, unless it is in ``exclude``.

    The value of a day that stays comes from all its readings, also those of dropped hours.
    """
    _check("complete_hour_threshold", hour_threshold)
    _check("complete_day_threshold", day_threshold)
    need_hour, need_day = MINUTES_PER_HOUR * hour_threshold, HOURS_PER_DAY * day_threshold
    kept = F.col("_rows") >= need_hour
    has_value = kept & ((F.col("_values") >= need_hour) | _exempt(exclude)) & _value(mean_only).isNotNull()
    rolled = parts.groupBy(SITE, VARIABLE, floor_time(F.col("hour"), "DAY").alias(TS)).agg(
        F.sum("_sum").alias("_sum"), F.sum("_values").alias("_values"),
        F.count(F.when(kept, 1)).alias("_hours"), F.count(F.when(has_value, 1)).alias("_full"))
    value = F.when((F.col("_full") >= need_day) | _exempt(exclude), _value(mean_only))
    return rolled.where(F.col("_hours") >= need_day).select(SITE, VARIABLE, TS, value.alias(VALUE))


def both_grains(parts: DataFrame, hour_threshold: float = 0.8, day_threshold: float = 1.0,
                remove_partial: bool = True, mean_only: bool = False) -> DataFrame:
    """Hours and days in one table ``(grain, site, variable, ts, value)`` and one pass.

    Each hour part is counted into its hour and into its day, so the readings are prepared once even
    where both grains are wanted; only the small parts are shuffled again.
    """
    _check("complete_hour_threshold", hour_threshold)
    _check("complete_day_threshold", day_threshold)
    need_hour, need_day = MINUTES_PER_HOUR * hour_threshold, HOURS_PER_DAY * day_threshold
    kept = F.col("_rows") >= need_hour
    full = kept & (F.col("_values") >= need_hour) & _value(mean_only).isNotNull()
    buckets = F.array(
        F.struct(F.lit("HOUR").alias("grain"), F.col("hour").alias(TS)),
        F.struct(F.lit("DAY").alias("grain"), floor_time(F.col("hour"), "DAY").alias(TS)))
    rolled = parts.withColumns({"_kept": kept, "_full": full}).select(
        SITE, VARIABLE, "_sum", "_values", "_kept", "_full", F.explode(buckets).alias("_b")).groupBy(
        "_b.grain", SITE, VARIABLE, F.col("_b.ts").alias(TS)).agg(
        F.sum("_sum").alias("_sum"), F.sum("_values").alias("_values"),
        F.count(F.when(F.col("_kept"), 1)).alias("_kept"), F.count(F.when(F.col("_full"), 1)).alias("_full"))
    if not remove_partial:
        return rolled.select("grain", SITE, VARIABLE, TS, _value(mean_only).alias(VALUE))
    need = F.when(F.col("grain") == "HOUR", 1.0).otherwise(need_day)
    return rolled.where(F.col("_kept") >= need).select(
        "grain", SITE, VARIABLE, TS, F.when(F.col("_full") >= need, _value(mean_only)).alias(VALUE))


def hour_and_day(df: DataFrame, hour_threshold: float = 0.8, day_threshold: float = 1.0,
                 rate: str = "drop", remove_partial: bool = True, mean_only: bool = False,
                 exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Hourly and daily tables from one set of hour parts."""
    return of_parts(hour_parts(df, rate, mean_only), hour_threshold, day_threshold, remove_partial, mean_only, exclude)


def of_parts(parts: DataFrame, hour_threshold: float = 0.8, day_threshold: float = 1.0, remove_partial: bool = True,
             mean_only: bool = False, exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    if remove_partial:
        return (complete_hours(parts, hour_threshold, mean_only, exclude),
                complete_days(parts, hour_threshold, day_threshold, mean_only, exclude))
    return (densify(hourly(parts, mean_only).drop("_values", "_rows"), "HOUR", mean_only),
            densify(daily(parts, mean_only), "DAY", mean_only))


def summary_tables(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain hourly and daily means with completeness."""
    return hour_and_day(df, mean_only=True)


def load_shift_state(hours: DataFrame, schedule: DataFrame) -> DataFrame:
    """Hourly ``system_state`` from the schedule, ``normal`` outside every window."""
    return label(hours, schedule, "system_state", "normal")


def load_shift_days(days: DataFrame, schedule: DataFrame) -> DataFrame:
    """Daily ``load_shift_day``: a window of the site starts or ends on that day."""
    edges = schedule.select(SITE, F.explode(F.array(F.to_date("start"), F.to_date("end"))).alias("_d")).distinct()
    joined = days.withColumn("_d", F.to_date(TS)).join(edges.withColumn("_hit", F.lit(True)), [SITE, "_d"], "left")
    return joined.withColumn("load_shift_day", F.coalesce("_hit", F.lit(False))).drop("_d", "_hit")


def signal_state(df: DataFrame, signal: str, names: dict[int, str]) -> tuple[DataFrame, DataFrame]:
    """Hourly state and daily flag from a minute load-shift signal.

    The hourly mean is rounded half to even and mapped to a name.
    """
    table = F.create_map(*[F.lit(x) for k, v in names.items() for x in (int(k), v)])
    usable = df.where((F.col(VARIABLE) == signal) & (F.abs(F.col(VALUE)) < F.lit(float("inf"))))
    hours = usable.groupBy(SITE, floor_time(F.col(TS), "HOUR").alias(TS)).agg(F.avg(VALUE).alias("_mean")).select(
        SITE, TS, F.try_element_at(table, F.bround("_mean").cast("int")).alias("system_state"))
    days = hours.groupBy(SITE, floor_time(F.col(TS), "DAY").alias(TS)).agg(
        F.coalesce(F.bool_or(F.col("system_state") != "normal"), F.lit(False)).alias("load_shift_day"))
    return hours, days


def gap_statistics(df: DataFrame, grain: str = "MINUTE") -> DataFrame:
    """Per series and full day: missing slots, mean gap and longest gap.

    The days start with a site's first full day and end before the day of its last reading. A gap is what lies between neighbouring slots
    with a value, or between one and an end of the day, so only those slots are read; a day without any is one gap.
    """
    day = floor_time(F.col(TS), "DAY")
    per_day = {"MINUTE": 1440, "HOUR": 24, "DAY": 1}[grain.upper()]
    hour = F.hour(TS)
    place = {"MINUTE": hour * 60 + F.minute(TS), "HOUR": hour, "DAY": F.lit(0)}[grain.upper()]
    filled = df.where(F.col(VALUE).isNotNull()).select(SITE, VARIABLE, day.alias("day"), place.cast("int").alias("at")).distinct()
    w = Window.partitionBy(SITE, VARIABLE, "day").orderBy("at")
    before = F.col("at") - F.coalesce(F.lag("at").over(w), F.lit(-1)) - 1
    after = F.when(F.lead("at").over(w).isNull(), F.lit(per_day - 1) - F.col("at"))
    gaps = filled.select(SITE, VARIABLE, "day", before.alias("_before"), after.alias("_after")).groupBy(SITE, VARIABLE, "day").agg(
        (F.sum("_before") + F.coalesce(F.sum("_after"), F.lit(0))).alias("missing"),
        (F.count(F.when(F.col("_before") > 0, 1)) + F.count(F.when(F.col("_after") > 0, 1))).alias("_gaps"),
        F.greatest(F.max("_before"), F.max("_after")).alias("max_gap"))
    span = df.groupBy(SITE).agg(F.min(TS).alias("_lo"), F.max(TS).alias("_hi"))
    floor_lo = floor_time(F.col("_lo"), "DAY")
    first = F.when(F.col("_lo") == floor_lo, floor_lo).otherwise(floor_lo + step("DAY"))
    last = floor_time(F.col("_hi"), "DAY") - step("DAY")
    bounds = span.select(SITE, first.alias("_a"), last.alias("_b")).where("_a <= _b")
    days = bounds.select(SITE, F.explode(F.sequence("_a", "_b", step("DAY"))).alias("day"))
    full = df.select(SITE, VARIABLE).distinct().join(days, SITE).join(gaps, [SITE, VARIABLE, "day"], "left")
    none = F.lit(per_day)
    return full.select(
        SITE, VARIABLE, "day", F.coalesce("missing", none).cast("bigint").alias("missing_slots"),
        F.when(F.col("missing").isNull(), none.cast("double")).when(F.col("_gaps") > 0, F.col("missing") / F.col("_gaps")).otherwise(0.0).alias("avg_gap"),
        F.coalesce("max_gap", none).cast("bigint").alias("max_gap"))


def rolling_blocks(days: DataFrame, columns: list[str], size: int, key: str = SITE, ts: str = TS) -> DataFrame:
    """Sums over each ``size`` consecutive daily rows, named by the last row.

    Rows are days, so a site's window is bounded by the calendar.
    """
    if size < 1:
        raise ValueError("the period must have at least one day")
    w = Window.partitionBy(key).orderBy(ts).rowsBetween(-(size - 1), 0)
    sums = {c: F.coalesce(F.sum(c).over(w), F.lit(0.0)) for c in columns}
    return days.withColumn("_n", F.count(F.lit(1)).over(w)).withColumns(sums).where(F.col("_n") == size).drop("_n")


def first_outage_per_day(df: DataFrame, column: str, supply_temp: float = 110, rows: int = 15,
                         days: DataFrame | None = None) -> DataFrame:
    """Days on which the supply is too cold for ``rows`` rows running, with the first start.

    With ``days`` (a daily table) only its days are looked at.
    """
    cold = df.where(F.col(VARIABLE) == column).select(
        SITE, TS, floor_time(F.col(TS), "DAY").alias("day"), (F.col(VALUE) < supply_temp).alias("cold"))
    first = streaks(cold, "cold", rows, [SITE, "day"]).groupBy(SITE, "day").agg(F.min("start").alias("first"))
    if days is not None:
        first = first.join(days.select(SITE, floor_time(F.col(TS), "DAY").alias("day")).distinct(), [SITE, "day"], "left_semi")
    detail = F.concat(F.lit("Hot Water Outage Occured (first one starting at "), F.date_format("first", "HH:mm"), F.lit(")"))
    return first.select(
        SITE, F.col("day").alias("start_time_pt"),
        (F.col("day") + step("DAY") - step("MINUTE")).alias("end_time_pt"),
        F.lit("ALARM").alias("event_type"), detail.alias("event_detail"))

"""Cleaning of long readings by rule tables.

Rule tables are joined without a broadcast hint: Spark broadcasts a table it knows to be small and
shuffles a larger one, with skew handling by adaptive execution.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.times import convert_zone, floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE, known
from wattloom.operators.sequences import day_segment, ordered

# Fixed value: rows up to this moment are logger clock resets.
CLOCK_RESET = "2000-01-01 00:00:00"


def rules_for(rules: DataFrame, site: str | None = None, system: str | None = None) -> DataFrame:
    """Keep the rules of one site (equality) and one system (the text contains it as a pattern)."""
    if site:
        rules = rules.where(F.col("site") == site)
    if system:
        rules = rules.where(F.coalesce(F.col("system").rlike(system), F.lit(False)))
    return rules


def rule_of(df: DataFrame, rules: DataFrame, *columns: str, name: str = "variable_name", how: str = "left") -> DataFrame:
    """Join the rule of each reading, as ``_r_<column>``; rules without a site hold for every site.

    A name has one rule, however many rows (aliases) repeat it; rows that disagree fail when the plan runs.
    """
    keys = [SITE] if SITE in rules.columns else []
    named = rules.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(name).alias("_k_name"))
    if columns:
        problem = F.raise_error(F.concat(F.lit(f"rules disagree on {', '.join(columns)} of "), F.col("_k_name")))
        one = named.agg(F.collect_set(F.struct(*columns)).alias("_s")).select(
            "*", F.when(F.size("_s") > 1, problem).otherwise(F.col("_s")[0]).alias("_rule"))
        right = one.select(*[f"_k_{k}" for k in keys], "_k_name", *[F.col(f"_rule.{c}").alias(f"_r_{c}") for c in columns])
    else:
        right = named.agg(F.count(F.lit(1)).alias("_s")).drop("_s")
    condition = F.col(VARIABLE) == F.col("_k_name")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_k_{k}"))
    joined = df.join(right, condition, how)
    return joined if how == "left_semi" else joined.drop("_k_name", *[f"_k_{k}" for k in keys])


def rename_by_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Alias to true name; readings without a rule go, and moments with no value at all go.

    Several aliases may share a name.
    """
    names = rules.where(F.col("variable_name").isNotNull() & F.col("variable_alias").isNotNull())
    keys = [SITE] if SITE in rules.columns else []
    names = names.select(*keys, "variable_alias", "variable_name").distinct()
    renamed = rule_of(df, names, "variable_name", name="variable_alias", how="inner").withColumn(
        VARIABLE, F.col("_r_variable_name"))
    filled = renamed.groupBy(SITE, TS).agg(F.count(VALUE).alias("_n")).where("_n > 0").drop("_n")
    return renamed.join(filled, [SITE, TS], "left_semi").select(*df.columns)


def rename_wide(df: DataFrame, names: Mapping[str, str], keys: Sequence[str] = (SITE, TS)) -> DataFrame:
    """The wide form of renaming: a projection, then drop rows without any value."""
    kept = {a: n for a, n in names.items() if a in df.columns}
    return df.select(*keys, *[F.col(f"`{a}`").alias(n) for a, n in kept.items()]).dropna(
        "all", subset=list(kept.values()))


def floor_to(df: DataFrame, grain: str = "MINUTE", ts: str = TS) -> DataFrame:
    return df.withColumn(ts, floor_time(F.col(ts), grain))


def average_duplicates(df: DataFrame, drop_clock_reset: bool = True) -> DataFrame:
    """One reading per (site, ts, variable): the mean of the known values.

    Partial aggregation runs before the shuffle, so copies of a hot minute collapse in place.
    """
    kept = df.where(F.col(TS) > F.lit(CLOCK_RESET).cast("timestamp_ntz")) if drop_clock_reset else df
    return kept.groupBy(SITE, TS, VARIABLE).agg(F.avg(known(F.col(VALUE))).alias(VALUE))


def first_text(df: DataFrame, seq: str = "ingest_seq", text: str = "text") -> DataFrame:
    """Non-numeric duplicates: the first non-null text per moment in ingest order."""
    return df.groupBy(SITE, TS, VARIABLE).agg(
        F.min_by(text, F.when(F.col(text).isNotNull(), F.col(seq))).alias(text))


def merge_rows(df: DataFrame, columns: Sequence[str], seq: str = "ingest_seq",
               keys: Sequence[str] = (SITE, TS)) -> DataFrame:
    """Collapse wide rows of one time to the first non-null value per column."""
    return df.groupBy(*keys).agg(*[
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns])


def shift_zone(df: DataFrame, source: str = "UTC", target: str = "America/Los_Angeles", ts: str = TS) -> DataFrame:
    return df.withColumn(ts, convert_zone(F.col(ts), source, target))


def add_local_time(df: DataFrame, sites: DataFrame, ts: str = "time_utc", out: str = "time_local") -> DataFrame:
    """Local time of each site; ``sites`` has ``site`` and ``local_tz``."""
    zones = sites.select(SITE, "local_tz")
    return df.join(zones, SITE, "left").withColumn(
        out, convert_zone(F.col(ts), "UTC", F.col("local_tz"))).drop("local_tz")


def outliers_to_null(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Values outside ``[lower_bound, upper_bound]`` become NULL; either bound may be missing."""
    low, high = F.col("_r_lower_bound").cast("double"), F.col("_r_upper_bound").cast("double")
    value = F.when(F.col(VALUE) < low, None).when(F.col(VALUE) > high, None).otherwise(F.col(VALUE))
    return rule_of(df, rules, "lower_bound", "upper_bound").withColumn(VALUE, value).select(*df.columns)


def sentinel_to_null(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Values equal to the rule's ``error_value`` become NULL."""
    hit = F.col(VALUE) == F.col("_r_error_value").cast("double")
    return rule_of(df, rules, "error_value").withColumn(
        VALUE, F.when(hit, None).otherwise(F.col(VALUE))).select(*df.columns)


def forward_fill(
    df: DataFrame,
    rules: DataFrame,
    *,
    seq: str | None = None,
    seed: DataFrame | None = None,
    segment: Column | None = None,
) -> DataFrame:
    """Fill gaps per rule: ``changepoint`` 1 without limit, 0 for ``ffill_length`` rows, else none.

    ``seed`` holds the last stored value per ``(site, variable)``. It fills the first row of a series
    that has a rule, if that row is empty; a seeded variable that is absent from ``df`` is added as an
    empty series first. ``seq`` breaks ties of equal times. The fill limit counts rows, so
    the latest value is carried with the number of rows since it: one pass serves every limit.
    Series are cut by day; raw rows with many copies per minute want a finer ``segment``.
    """
    order = [TS] if seq is None else [TS, seq]
    segment = day_segment() if segment is None else segment
    start = df
    if seed is not None:
        ruled = rules.where("changepoint IS NOT NULL OR ffill_length IS NOT NULL")
        stored = rule_of(seed, ruled, how="left_semi").select(
            SITE, VARIABLE, F.col(VALUE).alias("_seed"))
        absent = seed.select(SITE, VARIABLE).join(df.select(SITE, VARIABLE).distinct(), [SITE, VARIABLE], "left_anti")
        empty = df.select(SITE, *order).distinct().join(absent, SITE).withColumn(VALUE, F.lit(None).cast("double"))
        start = df = df.unionByName(empty, allowMissingColumns=True)
        heads = df.groupBy(SITE, VARIABLE).agg(F.min(F.struct(*order)).alias("_head"))
        seeds = heads.join(stored, [SITE, VARIABLE]).select(
            SITE, VARIABLE, *[F.col(f"_head.{c}").alias(c) for c in order], "_seed")
        start = df.join(seeds, [SITE, VARIABLE, *order], "left").withColumn(
            VALUE, F.coalesce(VALUE, "_seed")).drop("_seed")
    carried = ordered(
        start, (SITE, VARIABLE), order, segment,
        last={"_latest": F.col(VALUE)}, rows_since={"_age": F.col(VALUE).isNotNull()},
    )
    change, limit = F.col("_r_changepoint").cast("int"), F.col("_r_ffill_length").cast("int")
    may_fill = (change == 1) | ((change == 0) & (F.col("_age") <= limit))
    value = F.coalesce(F.col(VALUE), F.when(may_fill, F.col("_latest")))
    return rule_of(carried, rules, "changepoint", "ffill_length").withColumn(VALUE, value).select(*df.columns)


def correct_points(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Overwrite readings at given times; ``corrections`` is (site, ts, variable, new_value)."""
    fixes = corrections.select(SITE, TS, VARIABLE, "new_value", F.lit(True).alias("_hit"))
    joined = df.join(fixes, [SITE, TS, VARIABLE], "left")
    return joined.withColumn(VALUE, F.when(F.col("_hit"), F.col("new_value")).otherwise(F.col(VALUE))).select(
        *df.columns)


def rename_history(df: DataFrame, moment: str, new: str, old: str, remove_old: bool = True) -> DataFrame:
    """Wide: before ``moment`` the new column takes the old sensor's values."""
    if old not in df.columns:
        return df
    current = F.col(new) if new in df.columns else F.lit(None).cast("double")
    out = df.withColumn(
        new, F.when(F.col(TS) < F.lit(moment).cast("timestamp_ntz"), F.col(old)).otherwise(current))
    return out.drop(old) if remove_old else out


class Adjustment(NamedTuple):
    """A dated change of a site's wiring; ``kind`` is ``add``, ``remove`` or ``swap``."""

    site: str
    applied: str
    kind: str
    sensor_1: str
    sensor_2: str | None = None


def adjust_sensors(df: DataFrame, adjustments: Sequence[Adjustment]) -> DataFrame:
    """Apply hand-entered adjustments in order of their dates.

    From its date on, ``remove`` empties a sensor and ``swap`` exchanges two labels. ``add`` changes
    nothing. All steps are projections, so the scan is read once and nothing is shuffled.
    """
    out = df
    for a in sorted(adjustments, key=lambda a: a.applied):
        since = (F.col(SITE) == a.site) & (F.col(TS) >= F.lit(a.applied).cast("timestamp_ntz"))
        if a.kind == "remove":
            gone = since & (F.col(VARIABLE) == a.sensor_1)
            out = out.withColumn(VALUE, F.when(~gone, F.col(VALUE)))
        elif a.kind == "swap":
            first, second = since & (F.col(VARIABLE) == a.sensor_1), since & (F.col(VARIABLE) == a.sensor_2)
            out = out.withColumn(VARIABLE, F.when(first, a.sensor_2).when(second, a.sensor_1).otherwise(F.col(VARIABLE)))
        elif a.kind != "add":
            raise ValueError(f"unknown adjustment {a.kind!r}")
    return out


def prepend_last_row(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Put the last stored wide row in front of new rows, on the columns both have."""
    common = [c for c in df.columns if c in stored.columns]
    return stored.select(*common).unionByName(df.select(*common))


def on_off_to_bool(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def flag(c: str) -> Column:
        return F.when(F.col(c).isin("ON", "On"), True).when(F.col(c).isin("OFF", "Off"), False)

    return df.withColumns({c: flag(c) for c in columns if c in df.columns})


def replace_humidity(df: DataFrame, field: DataFrame, since: str, column: str = "Humidity_ODRH") -> DataFrame:
    """After ``since`` take field readings ``(site, ts, reading)`` of the same time, else nothing."""
    joined = df.join(field.select(SITE, TS, F.col("reading").alias("_field")), [SITE, TS], "left")
    after = F.col(TS) > F.lit(since).cast("timestamp_ntz")
    # a gap before the date stays a gap: the field series only holds later times
    return joined.withColumn(column, F.when(after, F.col("_field")).otherwise(F.col(column))).select(*df.columns)


def outdoor_conditions(df: DataFrame, site: str) -> DataFrame:
    """Outdoor readings while the outdoor unit draws power, named after the site."""
    power = "Power_OD_total1" if "Power_OD_total1" in df.columns else "Power_DHP"
    return df.where(F.col(power) > 0.01).select(
        "time_utc", F.col("Temp_ODT").alias(f"{site}_ODT"), F.col("Humidity_ODRH").alias(f"{site}_ODRH"))

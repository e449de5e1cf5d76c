"""Forward fill and time aggregation of sparse raw rows, without a row per sensor and moment.

The raw rows of a site are its moments. They are numbered once, and so are its minutes, in time segments with one summary row each. A
reading then stands for a run of moments, from its own number to the one before the sensor's next reading or to where its fill limit
ends: limits are differences of numbers. Runs are cut at hours into pieces, at most one for each reading and each sensor and hour. Only
the first and the last minute of a piece can be shared with another piece; the minutes between have the piece's value. So hours are
summed from pieces, and minutes are made from them where they are wanted, after the last shuffle.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE, known
from wattloom.operators.aggregates import has_aggregate
from wattloom.operators.cleaning import CLOCK_RESET, rule_of
from wattloom.operators.sequences import day_segment, ordered

#: The segment of rows of reset clocks; they are filled from, and then go.
RESET = "0001-01-01 00:00:00"


class Filled(NamedTuple):
    """Pieces of filled runs, the hours of each site with their minutes, and its variables.

    A piece is ``(site, variable, hour, value, lo, hi, n_lo, n_hi)``: minutes by number, and of its first and last minute the moments
    that it covers.
    """

    pieces: DataFrame
    hours: DataFrame
    variables: DataFrame


def _numbered(df: DataFrame, seq: str | None) -> tuple[DataFrame, DataFrame]:
    """Readings with the numbers of their moment and minute, one for each variable and moment; and the hours of each site.

    Copies of a variable in one moment are averaged.
    """
    place = [TS] if seq is None else [TS, seq]
    reset = F.col(TS) <= F.lit(CLOCK_RESET).cast("timestamp_ntz")
    hour = F.when(reset, F.lit(RESET).cast("timestamp_ntz")).otherwise(floor_time(F.col(TS), "HOUR"))
    keyed = df.select(SITE, *place, VARIABLE, known(F.col(VALUE)).alias(VALUE), hour.alias("hour"))
    group = [SITE, "hour"]
    # the first window's order holds for the others, so rows are sorted once
    copies = Window.partitionBy(*group, *place, VARIABLE)
    one = keyed.withColumns({"_mean": F.avg(VALUE).over(copies), "_copy": F.row_number().over(copies.orderBy(VARIABLE))})
    one = one.where("_copy = 1").select(SITE, "hour", *place, VARIABLE, F.col("_mean").alias(VALUE))
    by_moment, by_minute = Window.partitionBy(*group).orderBy(*place), Window.partitionBy(*group).orderBy(TS)
    local = one.withColumns({
        "_first": F.row_number().over(Window.partitionBy(*group, *place).orderBy(VARIABLE)) == 1,
        "_n": F.dense_rank().over(by_moment), "_m": F.dense_rank().over(by_minute)})
    minute = Window.partitionBy(*group, TS)
    local = local.withColumns({"_a": F.min("_n").over(minute), "_b": F.max("_n").over(minute)})
    per_hour = local.groupBy(*group).agg(
        F.max("_n").alias("_moments"), F.max("_m").alias("_minutes"), F.collect_set(F.struct(F.col("_m").alias("m"), F.col(TS).alias("ts"))).alias("_of"))
    along, whole = Window.partitionBy(SITE).orderBy("hour"), Window.partitionBy(SITE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    hours = per_hour.select(
        SITE, "hour", F.row_number().over(along).alias("h"), F.coalesce(F.sum("_moments").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_minutes").over(before), F.lit(0)).alias("m0"), F.col("_minutes").alias("minutes"),
        F.sum("_moments").over(whole).alias("_all"), F.col("_of").alias("of"))
    rows = local.join(hours.drop("of", "minutes"), group)
    return rows.select(
        SITE, VARIABLE, TS, VALUE, "_first", "h", (F.col("_n") + F.col("_n0")).alias("n"), (F.col("_m") + F.col("m0")).alias("m"),
        (F.col("_a") + F.col("_n0")).alias("a"), (F.col("_b") + F.col("_n0")).alias("b"), F.col("_all").alias("all")), hours


def fill(df: DataFrame, rules: DataFrame, *, seq: str | None = None, seed: DataFrame | None = None) -> Filled:
    """Runs of each reading by its rule: ``changepoint`` 1 without limit, 0 for ``ffill_length`` moments, else none.

    A moment is a site's raw row: its time, and ``seq`` where times repeat. ``seed`` has the last stored value of sensors; it stands at
    the site's first moment for a sensor that has a rule and no value there.
    """
    rows, hours = _numbered(df, seq)
    moments = rows.where("_first").select(SITE, F.col("n").alias("_e"), F.col("m").alias("m_e"), F.col("h").alias("h_e"), F.col("a").alias("a_e"))
    columns = [SITE, VARIABLE, TS, VALUE, "h", "n", "m", "a", "b", "all"]
    known_rows = rows.where(F.col(VALUE).isNotNull()).select(columns)
    variables = df.select(SITE, VARIABLE)
    if seed is not None:
        ruled = rules.where("changepoint IS NOT NULL OR ffill_length IS NOT NULL")
        stored = rule_of(seed, ruled, how="left_semi").where(F.col(VALUE).isNotNull()).select(SITE, VARIABLE, F.col(VALUE))
        start = rows.where("_first AND n = 1").drop(VARIABLE, VALUE)
        at_start = known_rows.where("n = 1").select(SITE, VARIABLE)
        known_rows = known_rows.unionByName(stored.join(start, SITE).join(at_start, [SITE, VARIABLE], "left_anti").select(columns))
        variables = variables.unionByName(seed.select(SITE, VARIABLE).join(df.select(SITE).distinct(), SITE, "left_semi"))
    runs = rule_of(ordered(known_rows, (SITE, VARIABLE), ["n"], day_segment(), lead={"_next": F.col("n")}), rules, "changepoint", "ffill_length")
    change, length = F.col("_r_changepoint").cast("int"), F.col("_r_ffill_length").cast("long")
    limit = F.when(change == 1, F.col("all")).when((change == 0) & (length > 0), length).otherwise(0)
    ended = runs.withColumn("_e", F.least(F.col("_next") - 1, F.col("n") + limit, F.col("all"))).join(moments, [SITE, "_e"])
    spans = ended.withColumn("h", F.explode(F.sequence("h", "h_e")))
    inside = spans.join(hours.select(SITE, "hour", "h", "m0", "minutes"), [SITE, "h"]).where(F.col("hour") > F.lit(RESET).cast("timestamp_ntz"))
    lo = F.greatest("m", F.col("m0") + 1)
    hi = F.least("m_e", F.col("m0") + F.col("minutes"))
    last = F.when(F.col("hi") == F.col("m_e"), F.col("_e") - F.col("a_e") + 1).otherwise(1)
    first = F.when(F.col("lo") == F.col("m"), F.least("_e", "b") - F.col("n") + 1).when(F.col("lo") == F.col("m_e"), last).otherwise(1)
    pieces = inside.withColumns({"lo": lo, "hi": hi}).select(
        SITE, VARIABLE, "hour", VALUE, "lo", "hi", first.alias("n_lo"), last.alias("n_hi"))
    shown = hours.where(F.col("hour") > F.lit(RESET).cast("timestamp_ntz")).select(SITE, "hour", "m0", "minutes", "of")
    return Filled(pieces, shown, variables.distinct())


def hour_parts(filled: Filled, rate: str = "drop", mean_only: bool = False) -> DataFrame:
    """Sum, value count and minute count of each variable of a site in each of its hours, as ``aggregates.hour_parts`` gives them."""
    wanted = (lambda d: d) if rate == "mean" or mean_only else lambda d: d.where(has_aggregate(F.col(VARIABLE)))
    v, n_lo, n_hi, lo, hi = (F.col(c) for c in (VALUE, "n_lo", "n_hi", "lo", "hi"))

    def part(minute: Column, value: Column, count: Column) -> Column:
        return F.struct(minute.cast("long").alias("m"), value.alias("s"), count.cast("long").alias("c"))

    between = hi - lo - 1
    parts = F.filter(F.array(
        part(lo, v * n_lo, n_lo), part(hi, v * n_hi, F.when(hi > lo, n_hi)), part(F.lit(None), v * between, F.when(between > 0, between))),
        lambda p: p["c"].isNotNull())
    minutes = wanted(filled.pieces).select(SITE, VARIABLE, "hour", F.inline(parts)).groupBy(SITE, VARIABLE, "hour", "m").agg(
        F.sum("s").alias("s"), F.sum("c").alias("c"))
    whole = F.col("m").isNull()
    sums = minutes.groupBy(SITE, VARIABLE, "hour").agg(
        F.sum(F.when(whole, F.col("s")).otherwise(F.col("s") / F.col("c"))).alias("_sum"),
        F.sum(F.when(whole, F.col("c")).otherwise(1)).alias("_values"))
    places = filled.hours.select(SITE, "hour", F.col("minutes").cast("long").alias("_rows")).join(wanted(filled.variables), SITE)
    return places.join(sums, [SITE, VARIABLE, "hour"], "left").select(
        SITE, VARIABLE, "hour", "_sum", F.coalesce("_values", F.lit(0).cast("long")).alias("_values"), "_rows")


def minutes(filled: Filled) -> DataFrame:
    """``(site, ts, variable, value)``: each variable of a site in each of its minutes, NULL where nothing is known.

    Pieces and hours are shuffled; minutes are made from both where they meet.
    """
    names = filled.variables.groupBy(SITE).agg(F.collect_set(VARIABLE).alias("names"))
    no = lambda kind: F.lit(None).cast(kind)
    minute = "array<struct<m:bigint,ts:timestamp_ntz>>"
    own = filled.hours.join(names, SITE).select(
        SITE, "hour", F.transform("of", lambda x: F.struct((x["m"] + F.col("m0")).cast("long").alias("m"), x["ts"].alias("ts"))).alias("of"), "names",
        no("string").alias(VARIABLE), no("double").alias(VALUE), *[no("long").alias(c) for c in ("lo", "hi", "n_lo", "n_hi")])
    given = filled.pieces.select(
        SITE, "hour", no(minute).alias("of"), no("array<string>").alias("names"), VARIABLE, VALUE,
        *[F.col(c).cast("long").alias(c) for c in ("lo", "hi", "n_lo", "n_hi")])
    met = own.unionByName(given).repartition(SITE, "hour")
    entry = "struct<variable:string,m:bigint,ts:timestamp_ntz,s:double,c:bigint>"

    def made(variable: Column, m: Column, ts: Column, s: Column, c: Column) -> Column:
        return F.struct(variable.alias(VARIABLE), m.alias("m"), ts.alias(TS), s.alias("s"), c.cast("long").alias("c")).cast(entry)

    empty = F.flatten(F.transform("of", lambda x: F.transform("names", lambda v: made(v, x["m"], x["ts"], no("double"), F.lit(0)))))
    covered = F.when(F.col("lo") == F.col("hi"), F.col("n_lo"))
    held = F.transform(F.sequence("lo", "hi"), lambda m: made(
        F.col(VARIABLE), m, no("timestamp_ntz"), F.col(VALUE) * F.coalesce(covered, F.when(m == F.col("lo"), F.col("n_lo")).when(
            m == F.col("hi"), F.col("n_hi")).otherwise(1)),
        F.coalesce(covered, F.when(m == F.col("lo"), F.col("n_lo")).when(m == F.col("hi"), F.col("n_hi")).otherwise(1))))
    rows = met.select(SITE, "hour", F.inline(F.when(F.col("of").isNotNull(), empty).otherwise(held)))
    return rows.groupBy(SITE, "hour", VARIABLE, "m").agg(F.max(TS).alias(TS), F.sum("s").alias("s"), F.sum("c").alias("c")).select(
        SITE, TS, VARIABLE, (F.col("s") / F.when(F.col("c") > 0, F.col("c"))).alias(VALUE))

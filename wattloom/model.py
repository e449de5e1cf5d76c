"""Canonical tables and the rules for missing values.

Readings are kept long, ``(site, ts, variable, value)``; a missing reading is a row whose value is
NULL. Formulas across sensors use the wide form. ``site`` and ``variable`` are never NULL.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SITE, TS, VARIABLE, VALUE = "site", "ts", "variable", "value"
SERIES = (SITE, VARIABLE)

READINGS = "site string, ts timestamp_ntz, variable string, value double"
ALARMS = (
    "site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, alarm_type string, "
    "event_detail string, variable_name string, certainty int"
)
EVENTS = (
    "site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, "
    "event_detail string"
)
SCHEDULE = "site string, event string, start timestamp_ntz, end timestamp_ntz, seq long"


def known(value: Column) -> Column:
    """NaN becomes NULL, so that comparisons with a missing value are never true."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def finite(value: Column) -> Column:
    """NULL for NaN and both infinities: what a stored table accepts."""
    return F.when(F.abs(known(value)) < F.lit(float("inf")), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division where x/0 is a signed infinity, 0/0 is missing, and inf/inf is missing."""
    inf = F.lit(float("inf"))
    by_zero = F.when(numerator > 0, inf).when(numerator < 0, -inf)
    return F.when(denominator == 0, by_zero).otherwise(
        known(F.try_divide(numerator.cast("double"), denominator.cast("double")))
    )


def differs(actual: Column, expected: Column) -> Column:
    """True also when exactly one side is missing."""
    return ~actual.eqNullSafe(expected)


def to_long(wide: DataFrame, variables: Sequence[str], keys: Sequence[str] = (SITE, TS)) -> DataFrame:
    """Unpivot sensor columns. Rows with a missing value stay, so row counts keep their meaning."""
    numeric = [known(F.col(f"`{v}`")).alias(v) for v in variables]
    return wide.select(*keys, *numeric).unpivot(list(keys), list(variables), VARIABLE, VALUE)


def to_wide(long: DataFrame, variables: Sequence[str], keys: Sequence[str] = (SITE, TS)) -> DataFrame:
    """One column per listed variable. The list is given, so no extra job looks for it."""
    cells = [F.avg(F.when(F.col(VARIABLE) == v, F.col(VALUE))).alias(v) for v in variables]
    return long.where(F.col(VARIABLE).isin(list(variables))).groupBy(*keys).agg(*cells)


def complete_rows(long: DataFrame, variables: Sequence[str] | None = None, keys: Sequence[str] = (SITE, TS)) -> DataFrame:
    """Add a NULL row for each variable of a site that lacks a reading at one of its moments.

    A wide frame has such rows by nature; sparse long readings do not, and operators that count
    rows (streaks, fill limits, completeness) need them. A moment is ``keys``: a site and time, and for raw rows
    their order. The variables are those the site has reported, or the documented ones if they are given.
    Readings of a moment are gathered in one shuffle; a moment has a row per sensor, and copies stay.
    """
    keys = list(keys)
    rest = [c for c in long.columns if c not in keys]
    moments = long.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_have"))
    if variables is None:
        names = long.groupBy(SITE).agg(F.collect_set(VARIABLE).alias("_names"))
        moments = moments.join(names, SITE)
    else:
        moments = moments.withColumn("_names", F.array(*[F.lit(v) for v in variables]))
    types = dict(long.dtypes)
    absent = F.transform(F.array_except("_names", F.col(f"_have.{VARIABLE}")), lambda v: F.struct(*[
        (v if c == VARIABLE else F.lit(None).cast(types[c])).alias(c) for c in rest]))
    kept = F.col("_have") if variables is None else F.filter("_have", lambda r: F.array_contains("_names", r[VARIABLE]))
    return moments.select(*keys, F.inline(F.concat(kept, absent))).select(long.columns)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table of constants whose size Spark knows, so it can decide on a broadcast by itself."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    rows = [tuple(r) for r in rows]
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))

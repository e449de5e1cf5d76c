"""Upsert by key into a date-partitioned parquet table.

Stored values are never overwritten by NULL, infinities are stored as NULL, new columns are added and
columns without any value are ignored. Only the touched date partitions are read and rewritten: a run's dates are few, and go into the
filter of the stored table as values.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from wattloom.model import SITE, TS, VARIABLE, finite
from wattloom.session import cut_lineage

PARTITION = "date"
#: Dates of one run that are listed in the filter; a run over more days is filtered by its first and last one.
LISTED_DATES = 2000


def clean_for_store(df: DataFrame) -> DataFrame:
    """Infinities and NaN become NULL in every double column."""
    return df.withColumns({n: finite(F.col(f"`{n}`")) for n, t in df.dtypes if t in ("double", "float")})


def without_empty_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Drop columns that hold no value at all. One aggregate row comes to the driver."""
    others = [c for c in df.columns if c not in keep]
    if not others:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in others]).first()
    return df.drop(*[c for c in others if counts[c] == 0])


def merge_keep_existing(target: DataFrame, source: DataFrame, keys: Sequence[str], replace: bool = False) -> DataFrame:
    """Full outer join on the keys; a source value wins unless it is NULL, with ``replace`` also then. Columns of both sides stay."""
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys] + [
        c for c in source.columns if c not in keys and c not in target.columns]
    t, s = target.alias("t"), clean_for_store(source).withColumn("_in", F.lit(True)).alias("s")
    joined = t.join(s, keys, "full")

    def value(c: str):
        sides = [F.col(f"{a}.`{c}`") for a, df in (("s", source), ("t", target)) if c in df.columns]
        if replace and len(sides) == 2:
            return F.when(F.col("s._in"), sides[0]).otherwise(sides[1]).alias(c)
        return F.coalesce(*sides).alias(c)

    return joined.select(*keys, *[value(c) for c in columns])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None


def touched(target: DataFrame, dated: DataFrame) -> DataFrame:
    """Rows of the stored table on the dates of a run; the scan lists the partitions of those dates only."""
    days = [r[0] for r in dated.select(PARTITION).distinct().limit(LISTED_DATES + 1).collect()]
    if len(days) <= LISTED_DATES:
        return target.where(F.col(PARTITION).isin([d for d in days if d is not None]))
    low, high = dated.agg(F.min(PARTITION), F.max(PARTITION)).first()
    return target.where(F.col(PARTITION).between(low, high)).join(dated.select(PARTITION).distinct(), PARTITION, "left_semi")


def upsert(source: DataFrame, path: str, keys: Sequence[str] = (SITE, TS), ts: str = TS, replace: bool = False) -> None:
    """Write ``source`` into the table at ``path``; creates it when absent. ``replace`` lets NULL overwrite, for values derived anew."""
    spark = source.sparkSession
    # written once: the columns with values, the dates and the merge all read it
    dated = cut_lineage(source.withColumn(PARTITION, F.to_date(ts)))
    dated = dated if replace else without_empty_columns(dated, [*keys, PARTITION])
    target = read_table(spark, path)
    if target is None:
        merged = clean_for_store(dated)
    else:
        merged = merge_keep_existing(touched(target, dated), dated, [*keys, PARTITION], replace)
    # rebalancing gathers a partition's rows but lets adaptive execution split a hot site and day
    columns = f"{PARTITION}, {SITE}" if SITE in merged.columns else PARTITION
    balanced = spark.sql(f"SELECT /*+ REBALANCE({columns}) */ * FROM {{merged}}", merged=merged)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)


def load_readings(df: DataFrame, path: str) -> None:
    upsert(df, path, (SITE, TS, VARIABLE))


def store_all(base: str, *, minute: DataFrame | None = None, hour: DataFrame | None = None,
              day: DataFrame | None = None, statistics: DataFrame | None = None, alarms: DataFrame | None = None,
              events: DataFrame | None = None, data_loss: bool = False, now: Column | None = None) -> None:
    """Fan-out of one run's results: alarms first, then events, then the time tables.

    ``events`` go to the event store; with ``data_loss`` sites whose minutes have stopped get an event there as well.
    """
    from wattloom.sinks.alarm_store import load_alarms
    from wattloom.sinks.events import load_events

    if alarms is not None:
        load_alarms(alarms, f"{base}/alarm", f"{base}/alarm_inst")
    if events is not None or (data_loss and minute is not None):
        load_events(events, f"{base}/site_events", minute if data_loss else None, now)
    for name, df in (("minute", minute), ("hour", hour), ("day", day)):
        if df is not None:
            load_readings(df, f"{base}/{name}")
    if statistics is not None:
        upsert(statistics, f"{base}/day_stats", (SITE, VARIABLE, "day"), ts="day")


def raw_copy(df: DataFrame, base: str, name: str) -> None:
    """Keep a pull as it came, named by its start time."""
    df.write.mode("overwrite").option("header", "true").csv(f"{base}/{name}")


def append_conflicts(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", "true").csv(path)

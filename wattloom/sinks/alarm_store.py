"""Alarm parents (sessions of alarms up to three days apart) and their certainty segments."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.times import step
from wattloom.model import SITE
from wattloom.operators.intervals import certainty_coverage, with_group
from wattloom.operators.sequences import month_segment
from wattloom.session import cut_lineage
from wattloom.sinks import versions
from wattloom.sinks.upsert import read_table

KEYS = [SITE, "alarm_type", "variable_name"]
MAX_GAP_DAYS = 3
TIMES = {"start": "start_time_pt", "end": "end_time_pt"}


#: Fixed value: the certainty of an alarm that states none.
DEFAULT_CERTAINTY = 3


def alarm_tables(new: DataFrame, parents: DataFrame | None = None, segments: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Parent and segment tables after taking in ``new`` alarms.

    ``parents`` is ``(id, *KEYS, start_time_pt, end_time_pt)``, ``segments`` is
    ``(id, *KEYS, start_time_pt, end_time_pt, certainty)``. Alarms of a key whose gap is under four
    days form one parent; a stored parent keeps its id, and the lowest id stays where a new alarm
    bridges two. Segments hold the highest certainty at each moment and never overlap. The grouped
    alarms are checkpointed, as both tables are made from them.
    """
    columns = [*KEYS, "start_time_pt", "end_time_pt"]
    level = F.coalesce("certainty", F.lit(DEFAULT_CERTAINTY)) if "certainty" in new.columns else F.lit(DEFAULT_CERTAINTY)
    spans = new.select(*columns, level.cast("int").alias("certainty"), F.lit(None).cast("bigint").alias("id"))
    for stored in (parents, segments):
        if stored is not None:
            level = F.col("certainty") if "certainty" in stored.columns else F.lit(None).cast("int")
            spans = spans.unionByName(stored.select(*columns, level.cast("int").alias("certainty"), "id"))
    # one row per start and certainty: copies of an alarm collapse before the sort
    spans = spans.groupBy(*KEYS, "start_time_pt", "certainty").agg(
        F.max("end_time_pt").alias("end_time_pt"), F.min("id").alias("id"))
    near = F.col("start_time_pt") - F.col("_reach") < step("DAY", MAX_GAP_DAYS + 1)
    grouped = cut_lineage(with_group(
        spans.withColumn("_rank", F.coalesce("certainty", F.lit(0))), KEYS, near, start="start_time_pt", end="end_time_pt",
        order=["start_time_pt", "_rank"], segment=month_segment("start_time_pt")))
    sessions = grouped.groupBy(*KEYS, F.col("_group").alias("start_time_pt")).agg(
        F.max("end_time_pt").alias("end_time_pt"), F.min("id").alias("id"))
    ids = sessions.withColumn("id", F.coalesce("id", F.xxhash64(*KEYS, "start_time_pt")))
    covered = certainty_coverage(
        grouped.where("certainty IS NOT NULL"), [*KEYS, "_group"], start="start_time_pt", end="end_time_pt")
    parts = covered.join(ids.select(*KEYS, F.col("start_time_pt").alias("_group"), "id"), [*KEYS, "_group"]).drop("_group")
    return ids.select("id", *columns), parts.select("id", *columns, "certainty")


def load_alarms(new: DataFrame, parent_path: str, segment_path: str) -> None:
    """Write both tables, rewriting only the partitions of sites with new alarms.

    Both results are checkpointed before the first write: each reads both stored tables.
    """
    spark = new.sparkSession
    stored = [read_table(spark, p) for p in (parent_path, segment_path)]
    sites = new.select(SITE).distinct()
    current = [None if t is None else t.join(sites, SITE, "left_semi") for t in stored]
    tables = [cut_lineage(t) for t in alarm_tables(new, *current)]
    for df, path in zip(tables, (parent_path, segment_path), strict=True):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SITE).parquet(path)


PARENTS = "id long, site string, alarm_type string, variable_name string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz"
SEGMENTS = f"{PARENTS}, certainty int"


def stored_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Parents and segments of the history at ``path``."""
    rows = versions.read(spark, versions.entries(spark, path), f"{SEGMENTS}, of_parent boolean")
    return (rows.where("of_parent").drop("of_parent", "certainty"), rows.where("NOT of_parent").drop("of_parent"))


def load_history(new: DataFrame, path: str) -> set[str]:
    """Take new alarms into a history by months; gives the months that were written anew.

    A session and its segments lie in the month in which the session starts, and each month's reach is the latest end in it. New alarms
    can only join sessions that end at most three days before the first of them and start at most three days after the last one ends, so
    months whose reach is earlier, or that begin later, are neither read nor written. In a month that is read only sessions of the same
    keys take part; the others are carried over. Both tables change in one commit.
    """
    spark = new.sparkSession
    new = cut_lineage(new)
    low, high = new.agg(F.min("start_time_pt") - step("DAY", MAX_GAP_DAYS + 1), F.max("end_time_pt") + step("DAY", MAX_GAP_DAYS + 1)).first()
    entries = versions.entries(spark, path)
    if low is None:
        return set()
    high = high or low
    near = [e for e in entries if e.folder and e.reach >= low and e.part <= f"{high:%Y-%m}"]
    held = versions.read(spark, near, f"{SEGMENTS}, of_parent boolean")
    parents = held.where("of_parent").where(
        (F.col("start_time_pt") <= F.lit(high)) & (F.col("end_time_pt") >= F.lit(low))).join(new.select(*KEYS).distinct(), KEYS, "left_semi")
    ids = cut_lineage(parents.select("id", versions.month("start_time_pt").alias("_month")))
    mine = held.join(ids.select("id"), "id", "left_semi")
    made_parents, made_segments = alarm_tables(new, mine.where("of_parent").drop("of_parent", "certainty"), mine.where("NOT of_parent").drop("of_parent"))
    starts = made_parents.select("id", versions.month("start_time_pt").alias("_month"))
    made = made_parents.select("*", F.lit(None).cast("int").alias("certainty"), F.lit(True).alias("of_parent")).unionByName(
        made_segments.withColumn("of_parent", F.lit(False))).join(starts, "id")
    made = cut_lineage(made)
    months = {r[0] for r in ids.select("_month").unionByName(made.select("_month")).distinct().collect()}
    touched = [e for e in entries if e.part in months]
    old = versions.read(spark, touched, f"{SEGMENTS}, of_parent boolean")
    month_of = old.where("of_parent").select("id", versions.month("start_time_pt").alias("_month"))
    kept = old.join(month_of, "id").join(ids.select("id"), "id", "left_anti")
    versions.write(kept.unionByName(made), path, F.col("_month"), F.col("end_time_pt"), entries, months)
    return months

"""Site events: upsert with respect for edited rows, and data-loss events."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.functions.times import step
from wattloom.model import SITE, TS
from wattloom.session import cut_lineage
from wattloom.sinks import versions

# Event types and which of them filter the summary and the optimisation figures.
EVENT_TYPES = (
    "MISC_EVENT", "DATA_LOSS", "DATA_LOSS_COP", "SITE_VISIT", "SYSTEM_MAINTENANCE", "EQUIPMENT_MALFUNCTION",
    "PARTIAL_OCCUPANCY", "INSTALLATION_ERROR", "ALARM", "SILENT_ALARM", "MV_COMMISSIONED", "PLANT_COMMISSIONED",
    "INSTALLATION_ERROR_COP", "SOO_PERIOD", "SOO_PERIOD_COP", "SYSTEM_TESTING",
)
SUMMARY_FILTERS = ("MV_COMMISSIONED", "PLANT_COMMISSIONED", "DATA_LOSS_COP", "SYSTEM_MAINTENANCE", "SYSTEM_TESTING")
OPTIM_FILTERS = (
    "MV_COMMISSIONED", "PLANT_COMMISSIONED", "DATA_LOSS_COP", "INSTALLATION_ERROR_COP", "PARTIAL_OCCUPANCY",
    "SOO_PERIOD_COP", "SYSTEM_TESTING", "EQUIPMENT_MALFUNCTION", "SYSTEM_MAINTENANCE",
)
UPLOADER = "automatic_upload"
DATA_LOSS_DETAIL = "Error processing data. Please check logs to resolve."
DATA_LOSS_DAYS = 3


def checked(events: DataFrame) -> DataFrame:
    """Fail on an unknown event type, when the plan runs."""
    kind = F.col("event_type")
    wrong = ~kind.isin(*EVENT_TYPES)
    return events.withColumn(
        "event_type", F.when(wrong, F.raise_error(F.concat(F.lit("unknown event type "), kind)).cast("string")).otherwise(kind))


def flags(kind: Column) -> dict[str, Column]:
    return {"summary_filtered": kind.isin(*SUMMARY_FILTERS), "optim_filtered": kind.isin(*OPTIM_FILTERS)}


def upsert_events(stored: DataFrame, new: DataFrame, now: Column | None = None, detail_chars: int | None = None) -> DataFrame:
    """The stored table after taking in ``new``.

    A new event matches a stored one on site, start, type, variable (NULL matches NULL) and its detail, or the first
    ``detail_chars`` characters of it. New events are the same only if their whole details are equal; of several that match one
    stored event by a short detail, the one that ends last updates it and the others are inserted. Only rows last written by the uploader are updated; an edited row stays
    as it is. Of several stored matches the one with the lowest id is updated. New events without a
    match get ids after the stored ones.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    key = [SITE, "start_time_pt", "event_type"]
    head = F.col("event_detail") if detail_chars is None else F.substring("event_detail", 1, detail_chars)
    loose = {"_variable": F.coalesce("variable_name", F.lit("")), "_head": F.coalesce(head, F.lit(""))}
    match = [*key, *loose]
    last = F.struct(F.coalesce("end_time_pt", F.col("start_time_pt")), "event_detail")
    distinct = checked(new).withColumns(loose).groupBy(*match, "event_detail").agg(
        F.max_by(F.struct("end_time_pt", "event_detail", "variable_name"), F.struct(F.coalesce("end_time_pt", F.col("start_time_pt")))).alias("_new"))
    incoming = distinct.select(*match, "_new.*").groupBy(*match).agg(
        F.max_by(F.struct("end_time_pt", "event_detail", "variable_name"), last).alias("_new"))
    old = stored.withColumns(loose)
    first = old.groupBy(*match).agg(F.min("id").alias("_first_id"))
    targets = first.join(incoming, match).select(F.col("_first_id").alias("id"), "_new")
    written = F.col("_new").isNotNull() & (F.col("last_modified_by") == UPLOADER)
    updated = stored.join(targets, "id", "left").withColumns({
        "end_time_pt": F.when(written, F.coalesce("_new.end_time_pt", "end_time_pt")).otherwise(F.col("end_time_pt")),
        "event_detail": F.when(written, F.coalesce("_new.event_detail", "event_detail")).otherwise(F.col("event_detail")),
        "last_modified_date": F.when(written, now).otherwise(F.col("last_modified_date")),
    }).select(*stored.columns)
    used = first.join(incoming, match).select(*match, F.col("_new.event_detail").alias("_used"))
    same = [F.col(f"d.{c}") == F.col(f"u.{c}") for c in match] + [F.col("d.event_detail").eqNullSafe(F.col("u._used"))]
    fresh = distinct.alias("d").join(used.alias("u"), same, "left_anti").select(
        # stable across re-runs, unlike a running number
        F.xxhash64(*match, F.coalesce("event_detail", F.lit(""))).alias("id"), *key, "_new.*")
    inserted = fresh.withColumns({
        **flags(F.col("event_type")), "last_modified_date": now, "last_modified_by": F.lit(UPLOADER)})
    return updated.unionByName(inserted, allowMissingColumns=True)


def data_loss_events(readings: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """A data-loss event per site whose newest reading is over three days old and none is open."""
    stale = readings.groupBy(SITE).agg(F.max(TS).alias("_newest")).where(now - F.col("_newest") > step("DAY", DATA_LOSS_DAYS))
    is_open = stored.where("end_time_pt IS NULL AND event_type = 'DATA_LOSS_COP'").select(SITE).distinct()
    return stale.join(is_open, SITE, "left_anti").select(
        SITE, now.alias("start_time_pt"), F.lit(None).cast("timestamp_ntz").alias("end_time_pt"),
        F.lit("DATA_LOSS_COP").alias("event_type"), F.lit(DATA_LOSS_DETAIL).alias("event_detail"),
        F.lit(True).alias("summary_filtered"), F.lit(True).alias("optim_filtered"))


STORED = ("id long, site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, event_detail string, "
          "variable_name string, summary_filtered boolean, optim_filtered boolean, last_modified_date timestamp_ntz, last_modified_by string")
#: The reach of a month in which an event has no end.
OPEN = "9999-12-31 00:00:00"


def stored_events(spark: SparkSession, path: str) -> DataFrame:
    """All events of the store, as the last complete load left them."""
    return versions.read(spark, versions.entries(spark, path), STORED)


def load_events(new: DataFrame | None, path: str, readings: DataFrame | None = None, now: Column | None = None,
                detail_chars: int | None = None) -> int:
    """Take new events, and data-loss events of sites whose ``readings`` have stopped, into the store; gives its version.

    Events lie by the month they start in. Only the months of new events are read and written anew, and months with open events are looked
    at for open data losses. The load shows as a whole or not at all. An unknown event type fails before anything is written.
    """
    given = [d for d in (new, readings) if d is not None]
    if not given:
        raise ValueError("neither events nor readings to look for data losses in")
    spark = given[0].sparkSession
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    columns = "site string, start_time_pt timestamp_ntz, end_time_pt timestamp_ntz, event_type string, event_detail string, variable_name string"
    names = [c.split(" ")[0] for c in columns.split(", ")]
    arrived = spark.createDataFrame([], columns)
    if new is not None:
        wrong = [r[0] for r in new.select("event_type").distinct().where(~F.coalesce(
            F.col("event_type").isin(*EVENT_TYPES), F.lit(False))).limit(20).collect()]
        if wrong:
            raise ValueError(f"unknown event types {wrong}")
        arrived = arrived.unionByName(new.select([c for c in names if c in new.columns]), allowMissingColumns=True)
    entries = versions.entries(spark, path)
    if readings is not None:
        open_months = [e for e in entries if str(e.reach) == OPEN]
        lost = data_loss_events(readings, versions.read(spark, open_months, STORED), now)
        arrived = arrived.unionByName(lost.select([c for c in names if c in lost.columns]), allowMissingColumns=True)
    arrived = cut_lineage(arrived)
    months = {r[0] for r in arrived.select(versions.month("start_time_pt")).distinct().collect()}
    before = versions.read(spark, [e for e in entries if e.part in months], STORED)
    after = upsert_events(before, arrived, now, detail_chars).select([c.split(" ")[0] for c in STORED.split(", ")])
    reach = F.coalesce("end_time_pt", F.lit(OPEN).cast("timestamp_ntz"))
    return versions.write(after, path, versions.month("start_time_pt"), reach, entries, months)

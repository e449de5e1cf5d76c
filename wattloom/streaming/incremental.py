"""New files in, late and duplicate rows settled, complete hours and days and streaks out."""

from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, VALUE, VARIABLE
from wattloom.operators.aggregates import HOURS_PER_DAY, MINUTES_PER_HOUR, has_aggregate, is_energy, of_parts
from wattloom.operators.joins import join_few
from wattloom.operators.sequences import SERIES, day_segment, ordered, streaks
from wattloom.session import cut_lineage
from wattloom.sinks import versions
from wattloom.sinks.upsert import PARTITION, load_readings, read_table, touched, upsert
from wattloom.sources.logger_csv import CORRECTED, PARSERS, REGISTERS

STREAM_READINGS = "site string, ts timestamp, variable string, value double"


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"streams need a UTC session zone, not {zone}")


def read_stream(spark: SparkSession, path: str, form: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Readings files as a stream; the checkpoint of the query remembers which files were read."""
    require_utc(spark)
    return spark.readStream.schema(STREAM_READINGS).option("maxFilesPerTrigger", files_per_batch).format(form).load(path)


def load_parts(parts: DataFrame, target: str, how: str = "mean") -> None:
    """Keep ``(site, ts, variable, part, at, _sum, _count)`` beside the target, and derive the target's touched values from all parts.

    A part is what one file or batch holds, so a batch that runs again replaces its own parts, and the target doesn't depend on how files
    were dealt to batches. ``how``: the mean of all parts, the ``latest`` part with a value, or the ``difference`` of registers.
    """
    spark, base = parts.sparkSession, f"{target.rstrip('/')}_parts"
    parts = cut_lineage(parts)
    upsert(parts, base, (SITE, TS, VARIABLE, "part"))
    keys = parts.select(SITE, TS, VARIABLE).distinct()
    stored = read_table(spark, base)
    if stored is None:  # no batch had rows yet
        return
    if how == "difference":
        # a row's difference hangs on the row before it, at whatever distance
        held = stored.join(keys.select(SITE, VARIABLE).distinct(), [SITE, VARIABLE], "left_semi")
    else:
        held = touched(stored, keys.withColumn(PARTITION, F.to_date(TS))).join(keys, [SITE, TS, VARIABLE], "left_semi")
    per = held.groupBy(SITE, TS, VARIABLE)
    if how == "latest":
        mean = F.col("_sum") / F.col("_count")
        rows = per.agg(F.max_by(F.when(F.col("_count") > 0, mean), F.when(
            F.col("_count") > 0, F.struct("at", "part"))).alias(VALUE))
    else:
        # the store keeps an infinite sum as NULL
        total = F.when(F.count("_sum") == F.count(F.lit(1)), F.sum("_sum"))
        rows = per.agg((total / F.when(F.sum("_count") > 0, F.sum("_count"))).alias(VALUE))
    if how == "difference":
        marked = rows.join(keys.withColumn("_new", F.lit(True)), [SITE, TS, VARIABLE], "left").withColumn(
            "_new", F.coalesce("_new", F.lit(False)))
        seen = ordered(marked, SERIES, (TS,), day_segment(), lag={"_prev": F.col(VALUE), "_prev_new": F.col("_new")})
        rows = seen.where(F.col("_new") | F.coalesce("_prev_new", F.lit(False))).select(
            SITE, TS, VARIABLE, (F.col(VALUE) - F.col("_prev")).alias(VALUE))
        upsert(rows, target, (SITE, TS, VARIABLE), replace=True)
    else:
        load_readings(rows, target)


def ingest_files(
    spark: SparkSession, path: str, kind: str, site: str, target: str, checkpoint: str,
    suffix: str = ".csv", files_per_batch: int = 1000, **options: Any,
) -> StreamingQuery:
    """Parse newly landed logger files and upsert them, then stop.

    A micro-batch holds whole files, so the batch parsers apply as they are. Sums and counts (for registers, of the registers) are kept
    by file in ``<target>_parts``, so the table is the same for any number of files per batch, and a batch that runs again changes nothing.
    """
    lines = spark.readStream.option("pathGlobFilter", f"*{suffix}").option("maxFilesPerTrigger", files_per_batch).text(path).select(
        F.col("_metadata.file_name").alias("file_name"), "value", F.col("_metadata.file_block_start").alias("_block"),
        F.unix_micros("_metadata.file_modification_time").alias("at"))
    how = "latest" if kind in CORRECTED else "difference" if kind in REGISTERS else "mean"

    def store(batch: DataFrame, _: int) -> None:
        numbered = batch.withColumn("pos", F.when(F.col("_block") == 0, F.monotonically_increasing_id())).drop("_block", "at")
        ages = batch.groupBy("file_name").agg(F.max("at").alias("at"))
        parts = PARSERS[kind](numbered, site, parts=True, **options)
        load_parts(join_few(parts, ages, ["file_name"]).withColumnRenamed("file_name", "part"), target, how)

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reported_parts(minutes: DataFrame, mean_only: bool = False) -> DataFrame:
    """Hour parts of sparse minutes, for each variable that its site reported on that day.

    An hour has as many rows as its site has minutes in it, so a silent sensor counts as missing without rows of its own.
    """
    kept = minutes if mean_only else minutes.where(has_aggregate(F.col(VARIABLE)))
    hour, day = floor_time(F.col(TS), "HOUR").alias("hour"), floor_time(F.col(TS), "DAY").alias("day")
    rows = minutes.select(SITE, TS).distinct().groupBy(SITE, hour, day).agg(F.count(F.lit(1)).alias("_rows"))
    names = kept.select(SITE, VARIABLE, day).distinct()
    sums = kept.groupBy(SITE, VARIABLE, hour).agg(F.sum(VALUE).alias("_sum"), F.count(VALUE).alias("_values"))
    return rows.join(names, [SITE, "day"]).join(sums, [SITE, VARIABLE, "hour"], "left").select(
        SITE, VARIABLE, "hour", "_sum", F.coalesce("_values", F.lit(0).cast("long")).alias("_values"), "_rows")


Streak = tuple[str, int]
STORED_STREAKS = "site string, variable string, rule string, start timestamp_ntz, end timestamp_ntz, length int"


def day_streaks(minutes: DataFrame, rules: Mapping[str, Streak]) -> DataFrame:
    """Streaks of each rule ``name: (condition, rows)`` in each sensor's days, as the batch rule counts them."""
    dated = minutes.withColumn("day", floor_time(F.col(TS), "DAY"))
    found = [streaks(dated.withColumn("hit", F.expr(condition)), "hit", need, [SITE, VARIABLE, "day"]).select(
        SITE, VARIABLE, F.lit(name).alias("rule"), "start", "end", "length") for name, (condition, need) in rules.items()]
    return reduce(DataFrame.unionByName, found)


def store_periods(
    stream: DataFrame, target: str, checkpoint: str, hour_threshold: float = 0.8, day_threshold: float = 1.0, *,
    mean_only: bool = False, rules: Mapping[str, Streak] | None = None,
) -> StreamingQuery:
    """Minutes, complete hours, complete days and streaks of all readings so far, below ``target``; stops when the input is drained.

    No reading is too late. Each batch adds its sums and counts by minute to the store, where a batch that runs again replaces its own,
    and the days that it touches are taken anew from all of their stored minutes. So the tables are those of a batch run over
    everything that has arrived, whatever the order and the batches were. Hours and days have the variables that a site reported on the
    day. ``rules`` are streak rules ``name: (condition, rows)``; a late row may join two streaks, which then are one.
    """

    def store(batch: DataFrame, number: int) -> None:
        naive = batch.select(SITE, VARIABLE, floor_time(F.col(TS).cast("timestamp_ntz"), "MINUTE").alias(TS), VALUE).groupBy(SITE, VARIABLE, TS).agg(
            F.coalesce(F.sum(VALUE), F.lit(0.0)).alias("_sum"), F.count(VALUE).alias("_count"))
        parts = cut_lineage(naive.select("*", F.lit(f"{checkpoint}#{number}").alias("part"), F.lit(number).cast("long").alias("at")))
        load_parts(parts, f"{target}/minute")
        spark = batch.sparkSession
        stored = read_table(spark, f"{target}/minute")
        if stored is None:
            return
        site_days = parts.select(SITE, F.to_date(TS).alias(PARTITION)).distinct()
        days = cut_lineage(touched(stored, site_days).join(site_days, [SITE, PARTITION], "left_semi").select(SITE, VARIABLE, TS, VALUE, PARTITION))
        minutes = days.drop(PARTITION)
        hour, day = of_parts(reported_parts(minutes, mean_only), hour_threshold, day_threshold, mean_only=mean_only)
        upsert(hour, f"{target}/hour", (SITE, TS, VARIABLE), replace=True)
        upsert(day, f"{target}/day", (SITE, TS, VARIABLE), replace=True)
        if rules:
            path = f"{target}/streak"
            entries = versions.entries(spark, path)
            dates = {r[0] for r in days.select(F.date_format(PARTITION, "yyyy-MM-dd")).distinct().collect()}
            before = versions.read(spark, [e for e in entries if e.part in dates], STORED_STREAKS).withColumn(PARTITION, F.to_date("start"))
            kept = before.join(site_days, [SITE, PARTITION], "left_anti").drop(PARTITION)
            rows = kept.unionByName(day_streaks(minutes, rules))
            versions.write(rows, path, F.date_format("start", "yyyy-MM-dd"), F.col("end"), entries, dates)

    return stream.select(SITE, VARIABLE, TS, VALUE).writeStream.foreachBatch(store).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_streaks(spark: SparkSession, target: str) -> DataFrame:
    return versions.read(spark, versions.entries(spark, f"{target}/streak"), STORED_STREAKS)


def minute_means(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One mean per sensor and minute, as soon as it is closed. Rows later than ``delay`` don't count here; ``store_periods`` takes them."""
    return stream.withWatermark(TS, delay).groupBy(
        SITE, VARIABLE, F.window(TS, "1 minute")).agg(F.avg(VALUE).alias(VALUE), F.count(F.lit(1)).alias("copies"))


def complete_hours(stream: DataFrame, threshold: float = 0.8, delay: str = "2 hours") -> DataFrame:
    """Closed hours with enough minutes, from minute means; chained windows in append mode.

    A sensor's minute counts as a row when it was reported at all, and as a value when it is known.
    """
    need = MINUTES_PER_HOUR * threshold
    hours = minute_means(stream, delay).groupBy(SITE, VARIABLE, F.window(F.window_time("window"), "1 hour")).agg(
        F.sum(VALUE).alias("_sum"), F.count(VALUE).alias("_values"), F.count(F.lit(1)).alias("_rows"))
    mean = F.col("_sum") / F.when(F.col("_values") > 0, F.col("_values"))
    value = F.when(is_energy(F.col(VARIABLE)), F.coalesce("_sum", F.lit(0.0))).otherwise(mean)
    return hours.where(F.col("_rows") >= need).select(
        SITE, VARIABLE, "window", F.col("window.start").alias(TS), F.when(F.col("_values") >= need, value).alias(VALUE))


def complete_days(stream: DataFrame, hour_threshold: float = 0.8, day_threshold: float = 1.0, delay: str = "2 hours") -> DataFrame:
    """Closed days with enough complete hours, fed by the hour windows.

    The daily value is taken over complete hours: the minutes of dropped hours are gone by then.
    """
    need = HOURS_PER_DAY * day_threshold
    hours = complete_hours(stream, hour_threshold, delay)
    days = hours.groupBy(SITE, VARIABLE, F.window(F.window_time("window"), "1 day")).agg(
        F.sum(VALUE).alias("_sum"), F.count(VALUE).alias("_values"), F.count(F.lit(1)).alias("_hours"))
    mean = F.col("_sum") / F.when(F.col("_values") > 0, F.col("_values"))
    value = F.when(is_energy(F.col(VARIABLE)), F.col("_sum")).otherwise(mean)
    return days.where(F.col("_hours") >= need).select(
        SITE, VARIABLE, F.col("window.start").alias(TS), F.when(F.col("_values") >= need, value).alias(VALUE))


STREAKS = "site string, variable string, start timestamp, end timestamp, length int"
# waiting rows as parallel arrays, and the open run
STREAK_STATE = "ts array<long>, hit array<boolean>, run_start long, run_hit long, run_last long, length int"
MINUTE_MS, DAY_MS = 60_000, 86_400_000


def streak_stream(stream: DataFrame, condition: str, need: int, delay: str = "10 minutes") -> DataFrame:
    """Streaks of ``need`` true rows per sensor and day, emitted when the run is over.

    Rows wait in the state until the watermark has passed them, so they are counted in time order
    whatever order they arrive in. A run ends at a false row or at midnight.
    """
    keyed = stream.withWatermark(TS, delay).select(SITE, VARIABLE, TS, F.coalesce(F.expr(condition), F.lit(False)).alias("hit"))
    return keyed.groupBy(SITE, VARIABLE).applyInPandasWithState(
        _count_streaks(need), STREAKS, STREAK_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _count_streaks(need: int) -> Callable:
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, hits, start, hit_at, last, length = state.get if state.exists else ([], [], None, None, None, 0)
        waiting = dict(zip(times or [], hits or [], strict=True))
        for frame in frames:
            millis = frame["ts"].astype("datetime64[ms]").astype("int64")
            waiting.update(zip(millis.tolist(), frame["hit"].tolist(), strict=True))
        mark = state.getCurrentWatermarkMs()
        found = []

        def close() -> None:
            nonlocal start, hit_at, last, length
            if length >= need:
                found.append((hit_at - (need - 1) * MINUTE_MS, last, length))
            start, hit_at, last, length = None, None, None, 0

        for t in sorted(t for t in waiting if t <= mark):
            if length and last // DAY_MS != t // DAY_MS:
                close()
            if waiting.pop(t):
                length += 1
                start = t if length == 1 else start
                hit_at = t if length == need else hit_at
                last = t
            elif length:
                close()
        if length and mark >= (last // DAY_MS + 1) * DAY_MS:
            close()
        if waiting or length:
            state.update((list(waiting), list(waiting.values()), start, hit_at, last, length))
            due = min(waiting) if waiting else (last // DAY_MS + 1) * DAY_MS
            state.setTimeoutTimestamp(max(due, mark + 1))
        elif state.exists:
            state.remove()
        if found:
            rows = pd.DataFrame(found, columns=["start", "end", "length"])
            rows.insert(0, "variable", key[1])
            rows.insert(0, "site", key[0])
            rows["start"] = pd.to_datetime(rows["start"], unit="ms")
            rows["end"] = pd.to_datetime(rows["end"], unit="ms")
            yield rows

    return step


def upsert_batches(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch of readings, then stop when the input is drained. What falls together is averaged over all batches."""

    def store(batch: DataFrame, number: int) -> None:
        naive = batch.groupBy(SITE, VARIABLE, F.col(TS).cast("timestamp_ntz").alias(TS)).agg(
            F.coalesce(F.sum(VALUE), F.lit(0.0)).alias("_sum"), F.count(VALUE).alias("_count"))
        load_parts(naive.select("*", F.lit(f"{checkpoint}#{number}").alias("part"), F.lit(number).cast("long").alias("at")), target)

    return stream.select(SITE, VARIABLE, TS, VALUE).writeStream.foreachBatch(store).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()

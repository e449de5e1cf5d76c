"""Operators on intervals ``(start, end)``: merging, coverage, sessions, and the interval join."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.times import step
from wattloom.model import SITE, TS
from wattloom.operators.sequences import month_segment, ordered

#: Tasks that the days and sites of an interval join are dealt into at least.
PARTS = 128
#: Readings of a site and day that meet a window together.
BLOCK = 128


def merge_touching(
    intervals: DataFrame,
    keys: Sequence[str],
    touches: Column,
    *,
    start: str = "start",
    end: str = "end",
    detail: str | None = None,
    segment: Column | None = None,
) -> DataFrame:
    """Merge intervals of a key; ``touches`` tells whether a row joins what came before.

    It may use the row's columns and ``_reach``, the latest end so far. Intervals of one key and start
    collapse to the longest first, so copies of a hot interval never reach the sort: without
    ``segment`` a key's window then holds at most one row per distinct start time. ``detail`` is taken
    from the earliest interval.
    """
    keys = list(keys)
    picked = [] if detail is None else [F.min(detail).alias(detail)]
    longest = intervals.groupBy(*keys, start).agg(F.max(end).alias(end), *picked)
    grouped = with_group(longest, keys, touches, start=start, end=end, segment=segment)
    first = [] if detail is None else [F.min_by(detail, start).alias(detail)]
    return grouped.groupBy(*keys, "_group").agg(F.max(end).alias(end), *first).withColumnRenamed("_group", start)


def with_group(
    intervals: DataFrame, keys: Sequence[str], touches: Column, *, start: str = "start", end: str = "end",
    order: Sequence[str] | None = None, segment: Column | None = None,
) -> DataFrame:
    """Add ``_group``, the start of the merged interval each interval belongs to."""
    order = [start] if order is None else list(order)
    reached = ordered(intervals, keys, order, segment, highest_before={"_reach": F.col(end)})
    opens = F.when(~F.coalesce(touches, F.lit(False)), F.col(start))
    return ordered(reached.withColumn("_opens", opens), keys, order, segment, last={"_group": F.col("_opens")}).drop(
        "_reach", "_opens")


def merge_alarms(alarms: DataFrame) -> DataFrame:
    """Merge alarms of one variable, type and certainty whose gap is at most one minute. A long history is cut by month."""
    near = F.col("start_time_pt") <= F.col("_reach") + step("MINUTE")
    merged = merge_touching(
        alarms, [SITE, "variable_name", "alarm_type", "certainty"], near,
        start="start_time_pt", end="end_time_pt", detail="event_detail", segment=month_segment("start_time_pt"),
    )
    return merged.select(
        SITE, "start_time_pt", "end_time_pt", "alarm_type", "event_detail", "variable_name", "certainty"
    )


def sessions(
    intervals: DataFrame, keys: Sequence[str], days: int = 4, start: str = "start", end: str = "end"
) -> DataFrame:
    """Merge intervals whose gap is under ``days`` whole days. Starts may be of any precision, so the
    series is cut by month."""
    return merge_touching(
        intervals, keys, F.col(start) - F.col("_reach") < step("DAY", days), start=start, end=end,
        segment=month_segment(start),
    )


def certainty_coverage(
    intervals: DataFrame, keys: Sequence[str], *, start: str = "start", end: str = "end",
    certainty: str = "certainty", levels: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """Cut intervals so that at each moment only the highest certainty remains.

    A certainty that is not in ``levels`` fails. An interval without length stays as it is, unless one of its certainty or a higher one
    covers that moment.

    A line sweep: each interval adds +1 at its start and -1 at its end to the count of its level;
    running sums give the levels that are open after each boundary. The boundary points are summed
    per time before the sweep, so copies of one interval cost nothing.
    """
    keys = list(keys)
    level = F.col(certainty)
    unknown = F.raise_error(F.concat(F.lit("unknown certainty "), F.coalesce(level.cast("string"), F.lit("NULL")))).cast("int")
    intervals = intervals.withColumn(certainty, F.when(F.coalesce(level.isin(list(levels)), F.lit(False)), level).otherwise(unknown))
    real = intervals.where(F.col(start) < F.col(end))
    edges = real.select(
        *keys, certainty,
        F.explode(F.array(
            F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
            F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
        )).alias("edge"),
    )
    points = edges.groupBy(*keys, F.col("edge.at").alias("at")).agg(*[
        F.sum(F.when(F.col(certainty) == n, F.col("edge.step")).otherwise(0)).alias(f"_d{n}") for n in levels
    ])
    seg = month_segment("at")
    open_now = ordered(points, keys, ["at"], seg, total={f"_o{n}": F.col(f"_d{n}") for n in levels})

    def top(count) -> Column:
        found = [F.when(count(n) > 0, F.lit(n)) for n in sorted(levels, reverse=True)]
        return F.coalesce(*found, F.lit(0)).cast("int")

    # the level before a boundary follows from the same sums, so no second pass looks back
    after, before = top(lambda n: F.col(f"_o{n}")), top(lambda n: F.col(f"_o{n}") - F.col(f"_d{n}"))
    changes = open_now.select(*keys, "at", after.alias("level"), before.alias("_was")).where("level <> _was")
    spans = ordered(changes, keys, ["at"], seg, lead={"_until": F.col("at")})
    found = spans.where("level > 0").select(
        *keys, F.col("at").alias(start), F.col("_until").alias(end), F.col("level").alias(certainty)
    )
    points_only = intervals.where(F.col(start) == F.col(end)).groupBy(*keys, start).agg(F.max(certainty).alias(certainty)).withColumn(
        end, F.col(start)).alias("p")
    spans_of = found.alias("s")
    covers = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [
        F.col(f"s.{start}") <= F.col(f"p.{start}"), F.col(f"s.{end}") >= F.col(f"p.{start}"), F.col(f"s.{certainty}") >= F.col(f"p.{certainty}")]
    return found.unionByName(points_only.join(spans_of, covers, "left_anti").select(found.columns))


def with_days(windows: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Repeat each half-open window for every day it touches, as ``_day``."""
    last = F.date_sub(F.to_date(F.col(end) - F.expr("INTERVAL '1' SECOND")), 0)
    return windows.where(F.col(start) < F.col(end)).withColumn(
        "_day", F.explode(F.sequence(F.to_date(start), F.greatest(last, F.to_date(start)))))


def inside(readings: DataFrame, windows: DataFrame, how: str = "inner", ts: str = TS, overlap: bool = True) -> DataFrame:
    """Interval join of readings with half-open windows of the same site.

    The day both sides share is an equality key, so the join can hash on ``(site, day)`` however large the schedule is. ``how`` may be
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    Where windows overlap, a day of a site gives up to its readings times its windows, so the size of the input does not tell how many
    tasks that takes. The days and sites of both sides are then dealt into ``PARTS`` at least: a broadcast would leave all these rows to
    the few tasks that read the other side's files, and small shuffles would be put together. An inner join then gives its rows by
    blocks of readings, as ``_by_blocks`` says. With ``overlap`` false the windows of a site are known to be apart, a reading meets one at
    most, and Spark broadcasts a small schedule.
    """
    left = readings.withColumn("_rday", F.to_date(ts))
    right = with_days(windows).withColumnRenamed(SITE, "_wsite")
    parts = max(PARTS, int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if overlap and how == "inner":
        return _by_blocks(readings, right, ts, parts)
    if overlap and how == "left":
        left, right = left.repartition(parts, SITE, "_rday"), right.repartition(parts, "_wsite", "_day").hint("merge")
    left, right = left.alias("r"), right.alias("w")
    matched = (
        (F.col(f"r.{SITE}") == F.col("w._wsite"))
        & (F.col("r._rday") == F.col("w._day"))
        & (F.col(f"r.{ts}") >= F.col("w.start"))
        & (F.col(f"r.{ts}") < F.col("w.end"))
    )
    return left.join(right, matched, how).drop("_rday", "_wsite", "_day")


def _by_blocks(readings: DataFrame, windows: DataFrame, ts: str, parts: int) -> DataFrame:
    """The inner join of readings and windows with ``_wsite`` and ``_day``, by blocks of a day's readings: a block with a window, then with the next one.

    There may be far more rows than readings and windows, so their order decides how much disk they take. Reading by reading, a window
    comes back after all others of its day, too far away for a column format to find the repeat. By blocks, a window's columns are runs
    and a block's columns are one short pattern. Blocks hold readings that follow each other, so most windows around a block are around
    all of it, and they are compared once a block.
    """
    packed = readings.select(F.struct("*").alias("_r")).select(
        F.col(f"_r.{SITE}").alias("_rsite"), F.to_date(f"_r.{ts}").alias("_rday"), "_r")
    number = F.row_number().over(Window.partitionBy("_rsite", "_rday").orderBy(f"_r.{ts}"))
    dealt = packed.where("_rsite IS NOT NULL AND _rday IS NOT NULL").repartition(parts, "_rsite", "_rday")
    blocks = dealt.withColumn("_block", F.floor((number - 1) / BLOCK)).groupBy("_rsite", "_rday", "_block").agg(
        F.min(f"_r.{ts}").alias("_from"), F.max(f"_r.{ts}").alias("_to"), F.collect_list("_r").alias("_readings"))
    near = (
        (F.col("_rsite") == F.col("w._wsite"))
        & (F.col("_rday") == F.col("w._day"))
        & (F.col("_to") >= F.col("w.start"))
        & (F.col("_from") < F.col("w.end"))
    )
    around = windows.repartition(parts, "_wsite", "_day").hint("merge").alias("w")
    pairs = blocks.join(around, near).select(F.explode("_readings").alias("_r"), "w.*")
    met = pairs.where((F.col(f"_r.{ts}") >= F.col("start")) & (F.col(f"_r.{ts}") < F.col("end")))
    return met.select("_r.*", *[c for c in windows.columns if c not in ("_wsite", "_day")])


def disjoint(windows: DataFrame, priority: str = "seq", name: str = "event") -> DataFrame:
    """``(site, start, end, <name>, <priority>)``: half-open windows cut so that none overlap; where some did, the highest priority stays.

    Of equal priorities the greatest name stays. A sweep needs the highest of all open windows after every edge; that set is not kept
    anywhere. A site's edges are numbered instead, a window is split into at most two aligned ranges of numbers of each size, and a
    range keeps only its best window, so hot ranges collapse before they are shuffled. The winner between two edges is the best of the
    aligned ranges around it. Windows without length or with a missing time, name or priority don't count.
    """
    real = windows.where(F.col("start") < F.col("end")).select(SITE, "start", "end", F.struct(priority, name).alias("w")).where(
        F.col(f"w.{priority}").isNotNull() & F.col(f"w.{name}").isNotNull())
    best = real.groupBy(SITE, "start", "end").agg(F.max("w").alias("w"))
    edges = best.select(SITE, F.explode(F.array("start", "end")).alias("at")).distinct()
    placed = ordered(edges, [SITE], ["at"], month_segment("at"), total={"i": F.lit(1)}, lead={"until": F.col("at")})
    first = placed.select(SITE, F.col("at").alias("start"), F.col("i").alias("lo"))
    last = placed.select(SITE, F.col("at").alias("end"), F.col("i").alias("hi"))
    spans = best.join(first, [SITE, "start"]).join(last, [SITE, "end"])
    # numbers lo to hi - 1: at each size the odd one at the left end and the even one at the right end stick out
    ranges = """filter(flatten(transform(sequence(0, length(bin(hi - lo))), l -> array(
        struct(l, shiftright(lo + shiftleft(1L, l) - 1, l) AS r,
               shiftright(lo + shiftleft(1L, l) - 1, l) < shiftright(hi, l) AND shiftright(lo + shiftleft(1L, l) - 1, l) % 2 = 1 AS ok),
        struct(l, shiftright(hi, l) - 1 AS r,
               shiftright(lo + shiftleft(1L, l) - 1, l) < shiftright(hi, l) AND shiftright(hi, l) % 2 = 1 AS ok)))), x -> x.ok)"""
    nodes = spans.select(SITE, "w", F.expr(f"inline({ranges})")).groupBy(SITE, "l", "r").agg(F.max("w").alias("w"))
    sizes = placed.groupBy(SITE).agg(F.expr("length(bin(max(i)))").alias("top"))
    slots = placed.where("until IS NOT NULL").join(sizes, SITE).select(
        SITE, "at", "until", F.expr("inline(transform(sequence(0, top), l -> struct(l, shiftright(i, l) AS r)))"))
    won = slots.join(nodes, [SITE, "l", "r"]).groupBy(SITE, "at", "until").agg(F.max("w").alias("w"))
    return won.select(SITE, F.col("at").alias("start"), F.col("until").alias("end"), f"w.{name}", f"w.{priority}")


def label(rows: DataFrame, schedule: DataFrame, out: str, default: str | None, ts: str = TS) -> DataFrame:
    """Name of the schedule window a row lies in; the later schedule row wins an overlap. A row meets one window at most."""
    named = disjoint(schedule).select(SITE, "start", "end", F.col("event").alias("_event"))
    joined = inside(rows, named, "left", ts, overlap=False)
    event = F.col("_event") if default is None else F.coalesce("_event", F.lit(default))
    return joined.withColumn(out, event).select(*[c for c in rows.columns if c != out], out)


def latest(df: DataFrame, keys: Sequence[str], ts: str = TS) -> DataFrame:
    """The row with the greatest time per key, as an aggregate rather than a sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])).alias("_r")).select(
        *keys, "_r.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")



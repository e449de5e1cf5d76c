"""Ordered-series operators that do not put a whole series into one task.

A plain window over ``(site, variable)`` sorts one series in one task, which fails when one sensor
or site holds a third of the rows. :func:`ordered` cuts every series into time segments, runs the
window inside each segment, reduces each segment to one summary row, runs the same window over the
summaries (one row per segment) and joins the carried state back. The large side is shuffled once, on
``(keys, segment)``; the join reuses that partitioning.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.times import floor_time, step, steps
from wattloom.model import SERIES, TS, differs


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | None = None,
    *,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    highest_before: Mapping[str, Column] | None = None,
    rows_since: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add columns computed along each series.

    ``lag``/``lead`` take the neighbouring row's value, ``last`` the latest non-null value up to and
    including the row, ``total`` the running sum including the row, ``highest_before`` the maximum
    over all earlier rows, ``rows_since`` the number of rows after the latest row where a condition
    held (all rows so far if it never did). ``order`` must be unique within a key. ``segment`` must
    never decrease along ``order``; without it one window per key is used, for keys whose rows are
    bounded (one sensor-day).
    """
    lag, lead, last = dict(lag or {}), dict(lead or {}), dict(last or {})
    total, highest, since = dict(total or {}), dict(highest_before or {}), dict(rows_since or {})
    keys, order = list(keys), list(order)
    if segment is None:
        group, cut = keys, df
    else:
        # Keys that cannot be NULL: the join below then adds no filter to one side only, both sides
        # keep the same shuffle, and Spark runs it once. Rows with a NULL key stay one series.
        solid = {f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("\0")) for i, k in enumerate(keys)}
        solid["_seg"] = F.coalesce(segment.cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz"))
        group, cut = list(solid), df.withColumns(solid)

    w = Window.partitionBy(*group).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns(
        {n: F.lag(c).over(w) for n, c in lag.items()}
        | {n: F.lead(c).over(w) for n, c in lead.items()}
        | {n: F.last(c, ignorenulls=True).over(upto) for n, c in last.items()}
        | {n: F.sum(c).over(upto) for n, c in total.items()}
        | {n: F.max(c).over(past) for n, c in highest.items()}
        | {f"_in_{n}": c for n, c in (lag | lead | highest).items() if segment is not None}
        | {f"_if_{n}": F.coalesce(c, F.lit(False)) for n, c in since.items()}
        | {"_nr": F.row_number().over(w)}
    )
    if since:
        local = local.withColumns(
            {f"_at_{n}": F.last(F.when(F.col(f"_if_{n}"), F.col("_nr")), ignorenulls=True).over(upto)
             for n in since}
        )
    names = [n for n in df.columns if n not in {*lag, *lead, *last, *total, *highest, *since}]
    if segment is None:
        nth = {n: F.col("_nr") - F.coalesce(F.col(f"_at_{n}"), F.lit(0)) for n in since}
        others = [*lag, *lead, *last, *total, *highest]
        return local.select(*names, *others, *[c.alias(n) for n, c in nth.items()])

    position = F.col("_nr")
    reduced = {"_rows": F.max("_nr")}
    if lag:
        reduced["_tail"] = F.max_by(F.struct(*[F.col(f"_in_{n}").alias(n) for n in lag]), position)
    if lead:
        reduced["_head"] = F.min_by(F.struct(*[F.col(f"_in_{n}").alias(n) for n in lead]), position)
    for name in [*last, *total]:
        reduced[f"_end_{name}"] = F.max_by(F.col(name), position)
    for name in highest:
        reduced[f"_end_{name}"] = F.max(f"_in_{name}")
    for name in since:
        reduced[f"_end_{name}"] = F.max(F.when(F.col(f"_if_{name}"), F.col("_nr")))
    summary = local.groupBy(*group).agg(*[c.alias(n) for n, c in reduced.items()])

    across = Window.partitionBy(*group[:-1]).orderBy("_seg")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
    if lag:
        carried["_tail"] = F.lag("_tail").over(across)
    if lead:
        carried["_head"] = F.lead("_head").over(across)
    for name in last:
        carried[f"_end_{name}"] = F.last(f"_end_{name}", ignorenulls=True).over(before)
    for name in total:
        carried[f"_end_{name}"] = F.sum(f"_end_{name}").over(before)
    for name in highest:
        carried[f"_end_{name}"] = F.max(f"_end_{name}").over(before)
    carry = summary.withColumns(carried)
    if since:
        carry = carry.withColumns({
            f"_end_{n}": F.col("_before") - F.coalesce(
                F.last(F.col("_before") + F.col(f"_end_{n}"), ignorenulls=True).over(before), F.lit(0))
            for n in since
        })

    final = F.col("_nr") == F.col("_rows")
    out = {n: F.when(F.col("_nr") == 1, F.col(f"_tail.{n}")).otherwise(F.col(n)) for n in lag}
    out |= {n: F.when(final, F.col(f"_head.{n}")).otherwise(F.col(n)) for n in lead}
    out |= {n: F.coalesce(F.col(n), F.col(f"_end_{n}")) for n in last}
    for n in total:
        out[n] = F.coalesce(F.col(n) + F.col(f"_end_{n}"), F.col(n), F.col(f"_end_{n}"))
    # greatest skips NULL, which is what an empty past needs
    out |= {n: F.greatest(F.col(n), F.col(f"_end_{n}")) for n in highest}
    for n in since:
        here = F.col("_nr") - F.col(f"_at_{n}")
        out[n] = F.coalesce(here, F.col("_nr") + F.col(f"_end_{n}"))
    return local.join(carry, group, "left").select(*names, *[c.alias(n) for n, c in out.items()])


def day_segment(ts: str = TS) -> Column:
    return floor_time(F.col(ts), "DAY")


def hour_segment(ts: str = TS) -> Column:
    return floor_time(F.col(ts), "HOUR")


def month_segment(ts: str = TS) -> Column:
    return F.trunc(F.col(ts), "MONTH").cast("timestamp_ntz")


def runs(
    df: DataFrame,
    mask: str,
    keys: Sequence[str],
    order: Sequence[str] = (TS,),
    segment: Column | None = None,
) -> DataFrame:
    """Number the runs of true rows: ``_run`` names a run and ``_nth`` is the place in it.

    A NULL mask counts as false. Rows that are false have ``_nth = 0``.
    """
    flagged = df.withColumn(mask, F.coalesce(F.col(mask), F.lit(False)))
    numbered = ordered(
        flagged, keys, order, segment, total={"_row": F.lit(1)}, rows_since={"_nth": ~F.col(mask)}
    )
    return numbered.withColumn("_run", F.col("_row") - F.col("_nth")).drop("_row")


def streaks(
    df: DataFrame,
    mask: str,
    need: Column | int,
    keys: Sequence[str],
    *,
    ts: str = TS,
    grain: str = "MINUTE",
    segment: Column | None = None,
    first: Mapping[str, Column] | None = None,
    trigger: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Runs of at least ``need`` consecutive true rows.

    ``start`` is the time of the ``need``-th row minus ``need - 1`` grains and ``end`` the time of
    the last row: rows are counted, not minutes. ``first`` and ``trigger`` name values to take from
    the run's first row and from its ``need``-th row. ``keys`` should hold the day for day-scoped
    rules, which bounds a window to one sensor-day; otherwise pass ``segment``.
    """
    need = F.lit(need) if isinstance(need, int) else need
    numbered = runs(df, mask, keys, (ts,), segment).withColumn("_need", need.cast("int"))
    at_trigger = F.col("_nth") == F.col("_need")
    picks = [F.max(F.when(F.col("_nth") == 1, c)).alias(n) for n, c in (first or {}).items()]
    picks += [F.max(F.when(at_trigger, c)).alias(n) for n, c in (trigger or {}).items()]
    grouped = (
        numbered.where(F.col(mask))
        .groupBy(*keys, "_run", "_need")
        .agg(
            F.count(F.lit(1)).cast("int").alias("length"),
            F.min(F.when(at_trigger, F.col(ts))).alias("_hit"),
            F.max(ts).alias("end"),
            *picks,
        )
        .where(F.col("length") >= F.col("_need"))
    )
    start = F.col("_hit") - steps(grain, F.col("_need") - 1)
    extra = [*(first or {}), *(trigger or {})]
    return grouped.select(*keys, start.alias("start"), "end", "length", *extra)


def short_runs(
    df: DataFrame, mask: str, below: int, keys: Sequence[str], *, ts: str = TS,
    segment: Column | None = None,
) -> DataFrame:
    """True runs shorter than ``below`` rows, except runs that touch either end of the series."""
    numbered = runs(df, mask, keys, (ts,), segment)
    grouped = numbered.where(F.col(mask)).groupBy(*keys, "_run").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).cast("int").alias("length")
    )
    edges = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return (
        grouped.where(F.col("length") < below)
        .join(edges, list(keys))
        .where((F.col("start") != F.col("_lo")) & (F.col("end") != F.col("_hi")))
        .select(*keys, "start", "end", "length")
    )


def past_warmup(
    df: DataFrame, mask: str, rows: int, keys: Sequence[str], out: str = "settled",
    order: Sequence[str] = (TS,), segment: Column | None = None,
) -> DataFrame:
    """True on the rows of a run after its first ``rows``."""
    return runs(df, mask, keys, order, segment).withColumn(
        out, F.col(mask) & (F.col("_nth") > rows)
    ).drop("_run", "_nth")


def transitions(
    df: DataFrame, above: Column, below: Column, keys: Sequence[str],
    order: Sequence[str] = (TS,), segment: Column | None = None,
) -> DataFrame:
    """Add ``turned_on`` and ``turned_off``: the mask changed since the previous row of the key."""
    seen = ordered(df, keys, order, segment, lag={"_was_above": above, "_was_below": below})
    true = lambda c: F.coalesce(c, F.lit(False))
    return seen.withColumns({
        "turned_on": true(F.col("_was_below") & above),
        "turned_off": true(F.col("_was_above") & below),
    }).drop("_was_above", "_was_below")


def event_ids(
    df: DataFrame, on: Column, keys: Sequence[str] = ("site",), ts: str = TS,
    segment: Column | None = None, mode: str = "rows",
) -> DataFrame:
    """Number HVAC events along each site as ``event_id``.

    ``mode="rows"``: the number starts at 1 and rises on an on-row after a gap over ten minutes and
    on each off-row from the third row on (on the second row only after an on-row); the first row
    keeps 0 or 1. ``mode="runs"``: one number per run of equal state.
    """
    state = df.withColumn("_on", F.coalesce(on, F.lit(False)))
    if mode == "runs":
        seen = ordered(state, keys, (ts,), segment, lag={"_was_on": F.col("_on")})
        changed = F.when(differs(F.col("_on"), F.col("_was_on")), 1).otherwise(0)
        numbered = ordered(seen, keys, (ts,), segment, total={"event_id": changed})
        return numbered.drop("_on", "_was_on")
    if mode != "rows":
        raise ValueError("mode must be 'rows' or 'runs'")
    seen = ordered(
        state, keys, (ts,), segment,
        lag={"_ts": F.col(ts), "_was_on": F.col("_on")}, total={"_row": F.lit(1)},
    )
    first = F.col("_row") == 1
    gap = (F.col(ts) - F.col("_ts")) > step("MINUTE", 10)
    rises = F.when(first, 0).when(F.col("_on"), F.when(gap, 1).otherwise(0)).when(
        (F.col("_row") > 2) | F.col("_was_on"), 1
    ).otherwise(0)
    numbered = ordered(seen.withColumn("_rise", rises), keys, (ts,), segment, total={"_sum": F.col("_rise")})
    number = F.when(first, F.when(F.col("_on"), 1).otherwise(0)).otherwise(1 + F.col("_sum"))
    return numbered.withColumn("event_id", number.cast("bigint")).drop(
        "_ts", "_was_on", "_row", "_rise", "_sum", "_on"
    )


def difference(
    df: DataFrame, value: str = "value", keys: Sequence[str] = SERIES, order: Sequence[str] = (TS,),
    segment: Column | None = None, when: Column | None = None,
) -> DataFrame:
    """Cumulative register to amount per interval: the value minus the previous row's value."""
    seen = ordered(df, keys, order, segment, lag={"_prev": F.col(value)})
    delta = F.col(value) - F.col("_prev")
    chosen = delta if when is None else F.when(when, delta).otherwise(F.col(value))
    return seen.withColumn(value, chosen).drop("_prev")

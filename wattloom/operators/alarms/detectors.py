"""Alarm detectors, grouped by shape so that detectors of one shape share one shuffle.

Readings are minute rows with a row per variable and time (NULL where nothing was reported); daily
rows likewise, with ``ts`` at midnight. Streak windows are keyed by sensor and day, which bounds them
to a day's rows. Every detector returns the alarm columns of :mod:`wattloom.model`.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.functions.times import floor_time, step
from wattloom.model import SITE, TS, VALUE, VARIABLE, differs, ratio
from wattloom.operators import sequences
from wattloom.operators.alarms import codes, text
from wattloom.operators.alarms.text import HIGH, LOW, MEDIUM, message, message_sql
from wattloom.operators.intervals import inside

DAY = "day"


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, floor_time(F.col(TS), "DAY"))


def _alarm(df: DataFrame, tag: str | Column, start: Column, end: Column, variable: Column, detail: Column,
           certainty: int | Column) -> DataFrame:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        SITE, start.alias("start_time_pt"), end.alias("end_time_pt"), lit(tag).alias("alarm_type"),
        detail.alias("event_detail"), variable.alias("variable_name"), lit(certainty).cast("int").alias("certainty"))


def on_days_of(alarms: DataFrame, daily: DataFrame) -> DataFrame:
    """Keep alarms on days the daily table has. Streaks never cross midnight, so filtering the few
    alarms equals filtering the readings."""
    days = daily.select(SITE, F.to_date(TS).alias("_d")).distinct()
    return alarms.withColumn("_d", F.to_date(F.col("start_time_pt"))).join(days, [SITE, "_d"], "left_semi").drop("_d")


# --- rules ----------------------------------------------------------------------------------------

class Settings(NamedTuple):
    """Bounds that codes without one take, by detector."""

    temp_low: float = 115
    temp_high: float = 130
    fuse_draw: float = 30
    inlet_power: float = 1.0
    inlet_temp: float = 115.0
    outlet_power: float = 1.0
    outlet_temp: float = 140.0
    tm_setpoint: float = 130.0
    tm_power: float = 1.0
    tm_share: float = 0.4
    backup_setpoint: float = 130.0
    backup_share: float = 0.1
    balancing_share: float = 0.4
    cop_low: float = 0.0
    cop_high: float = 4.5
    outage_share: float = 0.3
    cycle_power: float = 1.0
    change_power: float = 1.0
    on_temp: float = 115.0
    off_temp: float = 140.0


def _specs(s: Settings) -> list[codes.Spec]:
    cop = (s.cop_low, s.cop_high)
    return [
        codes.Spec(text.TEMP_RANGE, {"Temp": (s.temp_low, s.temp_high)}, ranged=True),
        codes.Spec(text.BLOWN_FUSE, {"PowerIn": s.fuse_draw}),
        codes.Spec(text.INLET, {"PowerIn": s.inlet_power, "Temp": s.inlet_temp}, roles="element"),
        codes.Spec(text.OUTLET, {"PowerIn": s.outlet_power, "Temp": s.outlet_temp}, roles="element"),
        codes.Spec(text.TM_SETPOINT, {"PowerIn": s.tm_power, "Temp": s.tm_setpoint, "Setpoint": s.tm_setpoint,
                                      "PowerIn_Total": s.tm_share}, roles="element"),
        codes.Spec(text.BACKUP, {"Setpoint": s.backup_setpoint, "PowerIn_Total": s.backup_share}),
        codes.Spec(text.BALANCING, {"PowerIn_Total": s.balancing_share}),
        codes.Spec(text.ABNORMAL_COP, {"COP": cop, "SystemCOP": cop}, ranged=True),
        codes.Spec(text.POWER_RATIO, {}, ranged=True, roles="ratio"),
        codes.Spec(text.OUTAGE, {"PowerIn": s.outage_share}),
        codes.Spec(text.SOO_CHANGE, {"PowerIn": s.change_power, "ON": s.on_temp, "OFF": s.off_temp}, roles="change"),
        codes.Spec(text.SHORT_CYCLE, {"PowerIn": s.cycle_power}),
        codes.Spec(text.SOO_SCHEDULE, {}, roles="code"),
    ]


TAGS = tuple(s.tag for s in _specs(Settings()))


def _is(*roles: str) -> Column:
    return F.coalesce(F.col("role").isin(list(roles)), F.lit(False))


def _checked(parsed: DataFrame, tags: set[str]) -> DataFrame:
    """What rows of one tag must be to each other. Only checks of tags that are wanted are planned."""
    power, temp, total, heat = _is("PowerIn"), _is("Temp"), _is("PowerIn_Total"), _is("HeatOut")
    on, off, in_total = _is("ON"), _is("OFF"), F.col("element") == "Total"
    said = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    tag, element = F.col("tag"), F.col("element")

    def pair(n):
        return (n(power | temp) > 0) & ((n(power) != 1) | (n(temp) != 1))

    def balance(n):
        return (n(power | total | heat) > 0) & ((n(total) > 1) | (n(power) < 1) | ((n(heat) < 1) & (n(total) != 1)))

    checks = [
        ((text.INLET, text.OUTLET), ["element"], pair, said(tag, " needs a power and a temperature for element ", element)),
        ((text.TM_SETPOINT,), ["element"], lambda n: (n(power) > 1) | (n(temp) > 1),
         said(tag, " needs a power and a temperature for element ", element)),
        ((text.TM_SETPOINT, text.BACKUP), [], lambda n: n(total) > 1, said("Improper alarm codes for ", tag, ": one total power at most")),
        ((text.BALANCING,), [], balance, said("Improper alarm codes for ", tag, ": needs power, and heat or one total")),
        ((text.POWER_RATIO,), [], lambda n: (n(in_total) > 0) & (n(in_total & total) != 1), said(tag, " needs one total power for a site")),
        ((text.OUTAGE,), [], lambda n: (n(power) > 0) & (n(total) != 1), said(tag, " needs one total power for a site")),
        ((text.SOO_CHANGE,), [], lambda n: n(power) != 1, said(tag, " needs one power variable for a site")),
        ((text.SOO_CHANGE,), ["element"], lambda n: (n(on | off) > 0) & ((n(on) != 1) | (n(off) != 1)),
         said(tag, " needs an ON and an OFF temperature for ", element)),
    ]
    single = [t for t in (text.TEMP_RANGE, text.BLOWN_FUSE, text.ABNORMAL_COP, text.SHORT_CYCLE) if t in tags]
    out = codes.one_per_variable(parsed, single) if single else parsed
    for of, by, wrong, problem in checks:
        if tags & set(of):
            out = codes.check(out, of, by, wrong, problem)
    return out


def book(rules: DataFrame, *tags: str, **settings: float) -> DataFrame:
    """The checked rules of these tags, of all tags without any; :func:`of_tag` picks those of a detector.

    All problems of all tags fail at once, here, whatever the readings are. Runs a small job.
    """
    specs = [s for s in _specs(Settings(**settings)) if not tags or s.tag in tags]
    return codes.settle(_checked(codes.read(rules, specs), {s.tag for s in specs}))


def of_tag(book: DataFrame, tag: str) -> DataFrame:
    return book.where(F.col("tag") == tag)


# --- one variable against its bounds -------------------------------------------------------------

def boundary_rules(rules: DataFrame, default_rows: int = 15) -> DataFrame:
    base = codes.settle(codes.boundary(rules, default_rows))
    sides = F.explode(F.array(F.lit("below"), F.lit("above"))).alias("kind")
    return base.select("*", F.lit(text.BOUNDARY).alias("tag"), sides)


def _value_rules(parsed: DataFrame, kind: str, need: int, low: Column, high: Column) -> DataFrame:
    keys = [SITE] if SITE in parsed.columns else []
    return parsed.select(*keys, VARIABLE, "pretty", low.alias("low"), high.alias("high"),
                         F.lit(need).alias("need"), "tag", F.lit(kind).alias("kind"))


def temp_range_rules(book: DataFrame, rows: int = 10) -> DataFrame:
    return _value_rules(of_tag(book, text.TEMP_RANGE), "outside", rows, F.col("bound"), F.col("bound2"))


def blown_fuse_rules(book: DataFrame, threshold: float = 1.0, margin: float = 2.0, rows: int = 3) -> DataFrame:
    return _value_rules(of_tag(book, text.BLOWN_FUSE), "between", rows, F.lit(float(threshold)), F.col("bound") - margin)


def setpoint_rules(book: DataFrame, tag: str, rows: int = 10) -> DataFrame:
    return _value_rules(of_tag(book, tag).where(_is("Setpoint")), "differs", rows, F.col("bound"), F.lit(None).cast("double"))


def outage_flag_rules(book: DataFrame) -> DataFrame:
    return _value_rules(of_tag(book, text.OUTAGE).where(_is("Alarm")), "differs", 1, F.lit(0.0), F.lit(None).cast("double"))


def value_streaks(minute: DataFrame, value_rules: DataFrame, grain: str = "MINUTE") -> DataFrame:
    """Streaks of one variable for every rule of this shape, in one pass over the readings."""
    mask = F.expr("""CASE kind WHEN 'below' THEN value < low WHEN 'above' THEN value > high
        WHEN 'outside' THEN value < low OR value > high WHEN 'between' THEN value > low AND value < high
        WHEN 'differs' THEN NOT (value <=> low) END""")
    joined = codes.attach(with_day(minute), value_rules.where("need >= 1")).withColumn("hit", mask)
    found = sequences.streaks(
        joined, "hit", F.col("need"), [SITE, VARIABLE, "tag", "kind", DAY], grain=grain,
        first={"low": F.col("low"), "high": F.col("high"), "pretty": F.col("pretty")},
        trigger={"actual": F.col(VALUE)})
    tags = (text.BOUNDARY, text.TEMP_RANGE, text.BLOWN_FUSE, text.TM_SETPOINT, text.BACKUP, text.OUTAGE)
    detail = F.expr("CASE tag " + " ".join(
        f"WHEN '{tag}' THEN {message_sql(tag, ('low', 'high', 'actual'))}" for tag in tags) + " END")
    return _alarm(found, F.col("tag"), F.col("start"), F.col("end") + step(grain), F.col(VARIABLE), detail, HIGH)


# --- power and temperature of one element --------------------------------------------------------

def pair_rules(book: DataFrame, tag: str, rows: int) -> DataFrame:
    """One row per element with its power and temperature variable and bounds."""
    parsed = of_tag(book, tag).where(_is("PowerIn", "Temp"))
    keys = [SITE] if SITE in parsed.columns else []
    pick = lambda c, role: F.max(F.when(_is(role), F.col(c)))
    pairs = parsed.groupBy(*keys, "tag", "element").agg(
        pick(VARIABLE, "PowerIn").alias("power_variable"), pick(VARIABLE, "Temp").alias("temp_variable"),
        pick("bound", "PowerIn").alias("power_bound"), pick("bound", "Temp").alias("bound"),
        pick("pretty", "PowerIn").alias("power_pretty"), pick("pretty", "Temp").alias("pretty"))
    return codes.settle(pairs.where("power_variable IS NOT NULL AND temp_variable IS NOT NULL").withColumn("need", F.lit(rows)))


def pair_streaks(minute: DataFrame, pairs: DataFrame, grain: str = "MINUTE", warmup: int = 10) -> DataFrame:
    """Streaks where the power is on and the temperature is past its bound."""
    keys = [SITE] if SITE in pairs.columns else []
    wanted = ["tag", "element", "power_bound", "bound", "pretty", "power_pretty", "power_variable", "temp_variable", "need"]
    members = pairs.select(
        *keys, *wanted,
        F.explode(F.array(
            F.struct(F.col("power_variable").alias(VARIABLE), F.lit(True).alias("is_power")),
            F.struct(F.col("temp_variable").alias(VARIABLE), F.lit(False).alias("is_power")))).alias("_m"),
    ).select(*keys, *wanted, "_m.*")
    power, temp = F.max(F.when(F.col("is_power"), F.col(VALUE))), F.max(F.when(~F.col("is_power"), F.col(VALUE)))
    rows = codes.attach(minute, members).groupBy(SITE, TS, *wanted).agg(power.alias("power"), temp.alias("temp"))
    tag = F.col("tag")
    on = F.when(tag == text.TM_SETPOINT, F.col("power") >= F.col("power_bound")).otherwise(F.col("power") > F.col("power_bound"))
    past = (
        F.when(tag == text.INLET, F.col("temp") > F.col("bound"))
        .when(tag == text.OUTLET, F.col("temp") < F.col("bound"))
        .otherwise(F.col("temp") >= F.col("bound"))
    )
    scope = [SITE, "tag", "element", DAY]
    timed = sequences.runs(with_day(rows).withColumn("on", on), "on", scope).withColumn(
        "hit", F.col("on") & past & (F.col("_nth") > F.when(tag == text.OUTLET, warmup).otherwise(0)))
    keep = {c: F.col(c) for c in ("bound", "pretty", "power_pretty", "power_variable", "temp_variable")}
    found = sequences.streaks(timed.drop("_nth", "_run"), "hit", F.col("need"), scope, grain=grain,
                              first=keep, trigger={"actual": F.col("temp")})
    detail = (
        F.when(tag == text.INLET, message(text.INLET))
        .when(tag == text.OUTLET, message(text.OUTLET))
        .otherwise(message("TMNSTPT draw", ("bound",)))
    )
    draw = tag == text.TM_SETPOINT
    return _alarm(found, tag, F.col("start"), F.col("end") + step(grain),
                  F.when(draw, F.col("power_variable")).otherwise(F.col("temp_variable")), detail,
                  F.when(draw, MEDIUM).otherwise(HIGH))


# --- daily shares -------------------------------------------------------------------------------

def share_rules(book: DataFrame, *tags: str) -> DataFrame:
    """Members of a daily share: summed power, heat, and one total; counts of each."""
    parsed = book.where(F.col("tag").isin(list(tags)) & _is("PowerIn", "PowerIn_Total", "HeatOut"))
    w = Window.partitionBy(*([SITE] if SITE in parsed.columns else []), "tag")
    n = lambda role: F.count(F.when(_is(role), 1)).over(w)
    return codes.settle(parsed.withColumns({
        "n_power": n("PowerIn"), "n_total": n("PowerIn_Total"), "n_heat": n("HeatOut"),
        "heat_variable": F.min(F.when(_is("HeatOut"), F.col(VARIABLE))).over(w)}))


def daily_shares(daily: DataFrame, members: DataFrame, grain: str = "MINUTE") -> DataFrame:
    """Share alarms of every tag in one daily aggregate."""
    role, v = F.col("role"), F.col(VALUE)
    power, heat = role == "PowerIn", role == "HeatOut"
    total = role == "PowerIn_Total"
    days = codes.attach(daily, members).groupBy(SITE, TS, "tag", "n_power", "n_total", "n_heat", "heat_variable").agg(
        F.coalesce(F.sum(F.when(power, v)), F.lit(0.0)).alias("power"), F.count(F.when(power, 1)).alias("_p"),
        F.coalesce(F.sum(F.when(heat, v)), F.lit(0.0)).alias("heat"), F.count(F.when(heat, 1)).alias("_h"),
        F.max(F.when(total, v)).alias("total"), F.max(F.when(total, F.col("bound"))).alias("share"),
        F.max(F.when(total, F.col(VARIABLE))).alias("total_variable"))
    tag = F.col("tag")
    known = F.col("total_variable").isNotNull() & (F.col("n_total") == 1) & (F.col("n_power") >= 1)
    all_power = F.col("_p") == F.col("n_power")
    over = (
        F.when(tag == text.TM_SETPOINT, (F.col("total") != 0) & (ratio(F.col("power"), F.col("total")) > F.col("share")))
        .otherwise(all_power & (F.col("power") >= F.col("total") * F.col("share")))
    )
    judged = days.withColumns({
        "over": F.coalesce(known & over, F.lit(False)),
        "percent": ratio(F.col("power"), F.col("total")) * 100, "limit": F.col("share") * 100})
    shares = judged.where("over")
    detail = (
        F.when(tag == text.TM_SETPOINT, message("TMNSTPT share", ("limit",)))
        .when(tag == text.BACKUP, message("IMBCKUP share"))
        .otherwise(message("BALVALV share"))
    )
    end = F.col(TS) + step("DAY")
    by_share = _alarm(
        shares, tag, F.col(TS), F.when(tag == text.BACKUP, end + step(grain)).otherwise(end),
        F.col("total_variable"), detail, F.when(tag == text.BACKUP, MEDIUM).otherwise(LOW))
    # heat comparison only for sites whose total share never fired
    quiet = judged.where(tag == text.BALANCING).groupBy(SITE).agg(F.bool_or("over").alias("_fired")).where("NOT _fired")
    warm = judged.where((tag == text.BALANCING) & (F.col("n_heat") >= 1) & all_power & (F.col("_h") == F.col("n_heat"))
                        & (F.col("power") > F.col("heat"))).join(quiet, SITE, "left_semi")
    by_heat = _alarm(warm, tag, F.col(TS), end, F.col("heat_variable"), message("BALVALV heat"), LOW)
    return by_share.unionByName(by_heat)


def abnormal_cop(daily: DataFrame, book: DataFrame) -> DataFrame:
    parsed = of_tag(book, text.ABNORMAL_COP)
    odd = codes.attach(daily, parsed).where((F.col(VALUE) > F.col("bound2")) | (F.col(VALUE) < F.col("bound")))
    odd = odd.withColumn("actual", F.when(F.abs(F.col(VALUE)) < float("inf"), F.round(VALUE, 2)).otherwise(F.col(VALUE)))
    return _alarm(odd, text.ABNORMAL_COP, F.col(TS), F.col(TS) + step("DAY"), F.col(VARIABLE),
                  message(text.ABNORMAL_COP, ("actual",)), HIGH)


# --- rolling blocks of days ----------------------------------------------------------------------

def with_stored_days(daily: DataFrame, stored: DataFrame | None, days: int) -> DataFrame:
    """Put the stored daily rows of the last ``days`` days before the new ones, per site."""
    if stored is None:
        return daily
    first = daily.groupBy(SITE).agg(F.min(TS).alias("_lo"))
    old = stored.join(first, SITE).where(
        (F.col(TS) < F.col("_lo")) & (F.col(TS) >= F.col("_lo") - step("DAY", days))).drop("_lo")
    return old.unionByName(daily, allowMissingColumns=True)


def _blocks(daily: DataFrame, parsed: DataFrame, days: int, by: list[str]) -> DataFrame:
    """Sum of each variable over ``days`` consecutive daily rows. Rows of a window are calendar days."""
    w = Window.partitionBy(SITE, VARIABLE, *by).orderBy(TS).rowsBetween(-(days - 1), 0)
    return codes.attach(daily, parsed).withColumns({
        "block": F.coalesce(F.sum(VALUE).over(w), F.lit(0.0)), "_n": F.count(F.lit(1)).over(w),
    }).where(F.col("_n") == days)


def power_ratio(daily: DataFrame, book: DataFrame, days: int = 7, stored: DataFrame | None = None) -> DataFrame:
    """Share of a group's power over a block of days: outside the range, or below it for heat pumps.

    Where the total of a block was not reported, shares of it are unknown and give no alarm.
    """
    if days < 1:
        raise ValueError("the ratio period must be at least one day")
    parsed = of_tag(book, text.POWER_RATIO)
    blocks = _blocks(with_stored_days(daily, stored, days) if days > 1 else daily, parsed, days, ["element"])
    is_total = F.col("role") == "PowerIn_Total"
    group_sum = F.when(F.col("element") == "Total", F.sum(F.when(is_total, F.col("block")))).otherwise(F.sum("block"))
    groups = blocks.groupBy(SITE, TS, "element").agg(group_sum.alias("_group"))
    shares = blocks.where(~is_total | (F.col("element") != "Total")).join(groups, [SITE, TS, "element"]).withColumn(
        "percent", ratio(F.col("block"), F.col("_group")) * 100)
    under, above = F.col("percent") < F.col("bound"), F.col("percent") > F.col("bound2")
    odd = shares.where(under | ((F.col("element") == "Total") & above)).withColumns({
        "days": F.lit(days), "ending": F.date_format(TS, "yyyy-MM-dd"), "group": F.col("element"),
        "low": F.col("bound"), "high": F.col("bound2")})
    return _alarm(odd, text.POWER_RATIO, F.col(TS) - step("DAY", days - 1), F.col(TS) + step("DAY"),
                  F.col(VARIABLE), message(text.POWER_RATIO), HIGH)


def outage_by_share(daily: DataFrame, book: DataFrame, flagged: DataFrame, days: int = 7, stored: DataFrame | None = None) -> DataFrame:
    """Heat pump power under its share of the total over a block, for sites with no flag alarm."""
    if days <= 1:
        raise ValueError("the ratio period must be more than one day")
    parsed = of_tag(book, text.OUTAGE).where(_is("PowerIn", "PowerIn_Total"))
    blocks = _blocks(with_stored_days(daily, stored, days), parsed, days, ["role"])
    totals = blocks.where("role = 'PowerIn_Total'").groupBy(SITE, TS).agg(
        F.when(F.count(F.lit(1)) == 1, F.max("block")).alias("_total"))
    low = blocks.where("role = 'PowerIn'").join(totals, [SITE, TS]).where(
        F.col("block") < F.col("_total") * F.col("bound"))
    quiet = low.join(flagged.select(SITE).distinct(), SITE, "left_anti")
    return _alarm(quiet, text.OUTAGE, F.col(TS), F.col(TS) + step("DAY"), F.col(VARIABLE), message("HPOUTGE share"), MEDIUM)


# --- operating modes ------------------------------------------------------------------------------

def short_cycle(minute: DataFrame, book: DataFrame, rows: int = 15, grain: str = "MINUTE") -> DataFrame:
    """On-runs shorter than ``rows``; a run may cross midnight, so the series is cut into segments."""
    parsed = of_tag(book, text.SHORT_CYCLE)
    joined = codes.attach(minute, parsed).select(
        SITE, VARIABLE, TS, "pretty", (F.col(VALUE) > F.col("bound")).alias("on"))
    found = sequences.short_runs(joined, "on", rows, [SITE, VARIABLE, "pretty"], segment=sequences.day_segment())
    return _alarm(found, text.SHORT_CYCLE, F.col("start"), F.col("end") + step(grain), F.col(VARIABLE),
                  message(text.SHORT_CYCLE), HIGH)


def soo_change(minute: DataFrame, book: DataFrame, schedule: DataFrame, margin: float = 5.0, grain: str = "MINUTE") -> DataFrame:
    """Heat pump turns on or off while the deciding temperature is away from its setpoint."""
    parsed = of_tag(book, text.SOO_CHANGE)
    keys = [SITE] if SITE in parsed.columns else []
    mode = F.when(F.col("element").isin(list(text.MODES)), F.col("element")).otherwise("normal")
    temps = parsed.where(_is("ON", "OFF")).withColumn("mode_key", mode)
    drives = parsed.where("role = 'PowerIn'").select(*keys, VARIABLE, F.col("bound").alias("threshold"))
    draw = codes.attach(minute, drives).select(SITE, TS, VALUE, "threshold")
    during = inside(draw, schedule).where(F.col("event").isin(list(text.MODES))).select(
        SITE, TS, VALUE, "threshold", F.col("event").alias("mode_key")).distinct()
    normal = inside(draw, schedule, "left_anti").withColumn("mode_key", F.lit("normal"))
    moments = with_day(during.unionByName(normal))
    above = F.col(VALUE) > F.col("threshold")
    below = F.col(VALUE) <= F.col("threshold")
    changed = sequences.transitions(moments, above, below, [SITE, "mode_key", DAY]).where("turned_on OR turned_off").select(
        SITE, TS, "mode_key", F.when(F.col("turned_on"), "ON").otherwise("OFF").alias("role"))
    labels = F.create_map(*[F.lit(x) for pair in text.MODES.items() for x in pair])
    watched = codes.attach(minute, temps.select(*keys, VARIABLE, "pretty", "bound", "role", "mode_key"))
    odd = changed.join(watched, [SITE, TS, "mode_key", "role"]).where(F.abs(F.col(VALUE) - F.col("bound")) > margin).withColumns({
        "start": F.col(TS), "actual": F.col(VALUE),
        "mode": F.coalesce(F.try_element_at(labels, F.col("mode_key")), F.lit("NORMAL"))})
    detail = F.when(F.col("role") == "ON", message("SOOCHNG on", ("bound",))).otherwise(message("SOOCHNG off", ("bound",)))
    return _alarm(odd, text.SOO_CHANGE, F.col(TS), F.col(TS) + step(grain), F.col(VARIABLE), detail, MEDIUM)


def schedule_mismatch(minute: DataFrame, book: DataFrame, schedule: DataFrame, grain: str = "MINUTE") -> DataFrame:
    """A mode variable that does not show the scheduled mode, per window; or the normal mode outside."""
    parsed = of_tag(book, text.SOO_SCHEDULE).where(_is("normal", *text.MODES))
    watched = codes.attach(minute, parsed).select(SITE, TS, VARIABLE, VALUE, "pretty", "bound", F.col("role").alias("mode"))
    during = inside(watched.where("mode <> 'normal'"), schedule).where("event = mode").select(*watched.columns, "seq")
    scheduled = schedule.select(SITE).distinct()
    normal = inside(watched.where("mode = 'normal'"), schedule, "left_anti").join(scheduled, SITE, "left_semi").withColumn(
        "seq", F.lit(-1).cast("bigint"))
    rows = with_day(during.unionByName(normal)).withColumn("hit", differs(F.col(VALUE), F.col("bound")))
    found = sequences.streaks(rows, "hit", 1, [SITE, VARIABLE, "mode", "seq", DAY], grain=grain,
                              first={"low": F.col("bound"), "pretty": F.col("pretty"), "actual": F.col(VALUE)})
    detail = F.when(F.col("mode") == "normal", message("SOOSCHD normal", ("low", "actual"))).otherwise(
        message("SOOSCHD mode", ("low", "actual")))
    return _alarm(found, text.SOO_SCHEDULE, F.col("start"), F.col("end") + step(grain), F.col(VARIABLE), detail, HIGH)

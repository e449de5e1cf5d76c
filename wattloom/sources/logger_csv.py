"""Logger CSV formats. Each parser takes lines ``(file_name, value, pos)`` and gives long readings.

Column sets differ between devices, so files are parsed by their own header line instead of one shared
CSV schema, and one job reads all files of a format.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.times import convert_zone, from_epoch
from wattloom.model import SITE, TS, VALUE, VARIABLE, known
from wattloom.operators.cleaning import average_duplicates, floor_to, rename_by_rules
from wattloom.operators.sequences import day_segment, difference
from wattloom.sources import files
from wattloom.sources.files import cell, marked_line, melt, nth_line, once, parse_time, stem, tabulate

# The formats' time columns, preamble lengths and default zone.
MODBUS_TIME, EPOCH_TIME, EGAUGE_TIME, NCLARITY_TIME = "time(UTC)", "DateEpoch(secs)", "Date & Time", "time"
DENT_PREAMBLE, DEFAULT_ZONE = 12, "US/Pacific"
FLOW_PARTS = ("Year", "Month", "Day", "Hour", "Minute", "Second")


def file_parts(readings: DataFrame) -> DataFrame:
    """Sum and count of the known values of each file, ``(site, ts, variable, file_name, _sum, _count)``: what other files can be added to."""
    value = known(F.col(VALUE))
    return readings.groupBy(SITE, TS, VARIABLE, "file_name").agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("_sum"), F.count(value).alias("_count"))


def _minutes(readings: DataFrame, parts: bool = False) -> DataFrame:
    """Floor to the minute and average what falls together; with ``parts`` leave it as sums of each file."""
    if parts:
        return file_parts(floor_to(readings))
    return average_duplicates(floor_to(readings.select(SITE, TS, VARIABLE, VALUE)), drop_clock_reset=False)


def plain(lines: DataFrame, site: str, time_column: str = "DateTime", form: str | None = "yyyy/MM/dd HH:mm:ss", parts: bool = False) -> DataFrame:
    table = tabulate(lines, marked_line(lines, time_column))
    rows = melt(table, parse_time(cell(time_column), form), [time_column], site)
    return file_parts(rows) if parts else rows.drop("file_name")


def modbus(lines: DataFrame, site: str, time_column: str = MODBUS_TIME, parts: bool = False) -> DataFrame:
    """Columns are prefixed with the device, the file name up to its first dot."""
    table = tabulate(lines, marked_line(lines, time_column))
    name = F.replace(F.concat_ws("_", stem(), "name"), F.lit(" "), F.lit("_"))
    return _minutes(melt(table, parse_time(cell(time_column)), [time_column], site, name), parts)


def dent(lines: DataFrame, site: str, preamble: int = DENT_PREAMBLE, parts: bool = False) -> DataFrame:
    """Meter files: a preamble, then a header whose first three columns are a number, date and time."""
    table = tabulate(lines, nth_line(lines, preamble + 1)).where(F.size("names") >= 3)
    moment = parse_time(F.concat_ws(" ", F.try_element_at("fields", F.lit(2)), F.try_element_at("fields", F.lit(3))))
    tail = lambda c: F.slice(c, F.lit(4), F.greatest(F.size(c) - 3, F.lit(0)))
    timed = once(table, "_ts", moment).withColumns({"names": tail("names"), "fields": tail("fields")})
    return _minutes(melt(timed, F.col("_ts"), [], site), parts)


def flow(lines: DataFrame, site: str, parts: bool = False) -> DataFrame:
    """Flow meter files: the time is in six integer columns, which stay out of the readings."""
    table = tabulate(lines, marked_line(lines, *FLOW_PARTS))
    timed = once(table, "_n", F.array(*[cell(p).try_cast("int") for p in FLOW_PARTS]))
    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *[F.col("_n")[i] for i in range(len(FLOW_PARTS))])
    moment = F.when(F.exists("_n", F.isnull), None).otherwise(text.try_cast("timestamp_ntz"))
    return _minutes(melt(timed, moment, list(FLOW_PARTS), site), parts)


def _epoch(column: str, zone: str) -> Column:
    return convert_zone(from_epoch(cell(column).try_cast("double")), "UTC", zone)


def _safe(*parts) -> Column:
    return F.translate(F.concat(*parts), " *", "__")


def msa(lines: DataFrame, site: str, zone: str = DEFAULT_ZONE, device_prefix: bool = False, parts: bool = False) -> DataFrame:
    table = tabulate(lines, marked_line(lines, EPOCH_TIME))
    name = _safe(stem(), F.col("name")) if device_prefix else None
    return _minutes(melt(table, _epoch(EPOCH_TIME, zone), [EPOCH_TIME], site, name), parts)


def egauge(lines: DataFrame, site: str, zone: str = DEFAULT_ZONE, parts: bool = False) -> DataFrame:
    """Cumulative registers, turned into the amount per minute; ``parts`` are of the registers themselves."""
    table = tabulate(lines, marked_line(lines, EGAUGE_TIME))
    name = _safe(stem(), F.lit("_"), F.col("name"))
    readings = _minutes(melt(table, _epoch(EGAUGE_TIME, zone), [EGAUGE_TIME], site, name), parts)
    return readings if parts else difference(readings, segment=day_segment())


def small_planet(lines: DataFrame, site: str, rules: DataFrame, zone: str = DEFAULT_ZONE, parts: bool = False) -> DataFrame:
    """Names come from the rule table while reading; undocumented columns and empty rows go."""
    table = tabulate(lines, marked_line(lines, EPOCH_TIME))
    readings = melt(table, _epoch(EPOCH_TIME, zone), [EPOCH_TIME], site, _safe(stem(), F.col("name")))
    # a variable's own name is accepted as well as its aliases
    own = rules.withColumn("variable_alias", F.col("variable_name"))
    return _minutes(rename_by_rules(readings, rules.unionByName(own)), parts)


def nclarity(lines: DataFrame, site: str, parts: bool = False) -> DataFrame:
    """The date is in the file name, the time of day in the file."""
    table = tabulate(lines, marked_line(lines, NCLARITY_TIME))
    date = files.sliced(F.col("file_name"), files.DAILY_NAME_START, files.DAILY_NAME_END)
    rows = melt(table, parse_time(F.concat_ws(" ", date, cell(NCLARITY_TIME))), [NCLARITY_TIME], site)
    return file_parts(rows) if parts else rows.drop("file_name")


def aqsuite(lines: DataFrame, site: str, parts: bool = False) -> DataFrame:
    """Keeps ``file_name`` for the registry of read files."""
    table = tabulate(lines, marked_line(lines, MODBUS_TIME))
    rows = melt(table, parse_time(cell(MODBUS_TIME)), [MODBUS_TIME], site)
    return file_parts(rows) if parts else rows


PARSERS: dict[str, Callable[..., DataFrame]] = {
    "csv": plain, "csv_mb": modbus, "csv_dent": dent, "csv_flow": flow, "csv_msa": msa, "csv_egauge": egauge,
    "csv_small_planet": small_planet, "csv_nclarity": nclarity, "csv_aqsuite": aqsuite,
}
#: Formats whose values are not averaged, where a later file corrects an earlier one, and those with cumulative registers.
CORRECTED, REGISTERS = ("csv", "csv_nclarity", "csv_aqsuite"), ("csv_egauge",)

"""Landed files: listing, pruning by name, and reading as lines."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattloom.functions.times import convert_zone, from_epoch
from wattloom.model import SITE
from wattloom.operators.joins import join_few

# Where a date sits in a file name, counted from its end, and its digits.
NAME_DATE_START, NAME_DATE_END = -17, -3
NAME_DATE_FORMAT = "yyyyMMddHHmmss"
DAILY_NAME_START, DAILY_NAME_END = -18, -8


def list_files(spark: SparkSession, path: str, suffix: str = "", prefix: str = "", recursive: bool = False) -> DataFrame:
    """``(path, file_name, length)`` of matching files; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*{suffix}").option(
        "recursiveFileLookup", str(recursive).lower()).load(path)
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def sliced(name: Column, start: int, end: int) -> Column:
    """Characters between two positions counted from the end of a name."""
    return F.substring(name, F.length(name) + start + 1, F.lit(end - start))


def name_date(name: Column, start: int = NAME_DATE_START, end: int = NAME_DATE_END, form: str = NAME_DATE_FORMAT) -> Column:
    """Time in a file name: digits in ``form``, or ``epoch`` seconds; NULL where there is none."""
    digits = sliced(name, start, end)
    if form == "epoch":
        return from_epoch(digits.try_cast("bigint"))
    return parse_time(digits, form)


def name_hex_epoch(name: Column, zone: str | None = None) -> Column:
    """Time from the hexadecimal epoch between the first dot and the next underscore."""
    digits = F.regexp_extract(name, r"\.(.*?)_", 1)
    seconds = F.when(digits.rlike("^[0-9A-Fa-f]+$"), F.conv(digits, 16, 10)).cast("bigint")
    return from_epoch(seconds) if zone is None else convert_zone(from_epoch(seconds), "UTC", zone)


def within(moment: Column, start: str | None = None, end: str | None = None, strict: bool = False) -> Column:
    """``start <= moment < end``; ``strict`` excludes the start itself."""
    keep = F.lit(True)
    if start is not None:
        low = F.lit(start).cast("timestamp_ntz")
        keep = keep & ((moment > low) if strict else (moment >= low))
    if end is not None:
        keep = keep & (moment < F.lit(end).cast("timestamp_ntz"))
    return keep


def parse_time(text: Column, form: str | None = None) -> Column:
    """Text to naive time, NULL where it does not parse.

    ISO dates with dashes or slashes and US dates with two- or four-digit years need no format and never
    pass through the session zone. Plain digit formats are rewritten to ISO as well.
    """
    if form == NAME_DATE_FORMAT:
        iso = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6")
        return F.when(text.rlike(r"^\d{14}$"), iso.try_cast("timestamp_ntz"))
    if form in (None, "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss"):
        whole = text.rlike(r"^\d{4}([-/])\d{2}\1\d{2} \d{2}:\d{2}:\d{2}$")
        iso = F.regexp_replace(F.trim(text), r"^(\d{4})/(\d{1,2})/", "$1-$2-")
        iso = F.regexp_replace(iso, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
        iso = F.regexp_replace(iso, r"^(\d{1,2})/(\d{1,2})/(\d{2}) ", "20$3-$1-$2 ")
        # the usual form is tested once, the others are rewritten first
        return F.when(whole, F.replace(text, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz")).when(
            iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")


def read_lines(spark: SparkSession, path, suffix: str = ".csv", prefix: str = "", recursive: bool = False) -> DataFrame:
    """Lines of many files as ``(file_name, value, pos)``; missing and corrupt files are skipped.

    ``pos`` grows along the first block of a file and is NULL in later blocks, so large files stay
    splittable and a preamble can still be found.
    """
    reader = spark.read.option("pathGlobFilter", f"{prefix}*{suffix}").option("recursiveFileLookup", str(recursive).lower())
    lines = reader.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true").text(path)
    first = F.col("_metadata.file_block_start") == 0
    return lines.select(
        F.col("_metadata.file_name").alias("file_name"), "value",
        F.when(first, F.monotonically_increasing_id()).alias("pos"))


def nth_line(lines: DataFrame, n: int) -> DataFrame:
    """The ``n``-th line of each file as ``(file_name, header)``.

    The rank filter is applied before the shuffle, so at most ``n`` lines per file and task move.
    """
    w = Window.partitionBy("file_name").orderBy("pos")
    ranked = lines.where("pos IS NOT NULL").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    return ranked.where(F.col("_n") == n).select("file_name", F.col("value").alias("header"), F.col("pos").alias("header_pos"))


def marked_line(lines: DataFrame, *marks: str) -> DataFrame:
    """The first line of each file that has every mark as a cell of its own, as ``(file_name, header, header_pos)``."""
    found = lines.where("pos IS NOT NULL")
    for mark in marks:
        found = found.where(F.contains("value", F.lit(mark)))
    own = F.lit(True)
    for mark in marks:
        own = own & F.array_contains(cells("value"), mark)
    first = found.where(own).groupBy("file_name").agg(F.min(F.struct("pos", "value")).alias("_h"))
    return first.select("file_name", F.col("_h.value").alias("header"), F.col("_h.pos").alias("header_pos"))


def cells(line: str) -> Column:
    """Fields of a line, without quotes and the blanks around them. A line without quotes is cut at every comma."""
    comma = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    quoted = F.transform(F.split(line, comma), lambda x: F.trim(F.regexp_replace(x, '^\\s*"|"\\s*$', "")))
    blanks = F.contains(line, F.lit(", ")) | F.contains(line, F.lit(" ,"))
    # fields are gone through one by one only where a comma has a blank beside it
    return F.when(F.contains(line, F.lit('"')), quoted).when(blanks, F.transform(F.split(line, ","), lambda x: F.trim(x))).otherwise(
        F.split(F.trim(line), ","))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once a row. Spark would copy its expression into filters and every later column; it copies none
    out of a generator."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def tabulate(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Give each line its file's column names: ``(file_name, names, fields)``, quotes removed.

    Lines up to the header are no data; lines without a position are in later blocks of their file.
    One header row per file meets its lines by file name; the lines of a file are dealt into parts, as files may be few and large.
    """
    data = F.col("pos").isNull() | (F.col("pos") > F.col("header_pos"))
    named = headers.withColumn("names", cells("header"))
    met = join_few(lines, named, ["file_name"]).where(data & (F.col("value") != F.col("header")))
    return once(met, "fields", cells("value")).select("file_name", "names", "fields")


def cell(name: str) -> Column:
    """The field under a column name."""
    at = F.array_position("names", F.lit(name)).cast("int")
    return F.when(at > 0, F.try_element_at("fields", at))


def melt(table: DataFrame, ts: Column, drop: list[str], site: str, rename: Column | None = None) -> DataFrame:
    """Tabulated lines to long readings; rows without a time go, a missing or textual field is NULL."""
    pairs = F.explode(F.arrays_zip(F.col("names").alias("name"), F.col("fields").alias("field")))
    rows = once(table, "ts", ts).where("ts IS NOT NULL").select("file_name", "ts", pairs.alias("_p")).select(
        "file_name", "ts", F.col("_p.name").alias("name"), F.col("_p.field").alias("field")).where(~F.col("name").isin(drop))
    # an empty field is no number; a cast would throw and catch an exception to find that
    value = F.when(F.col("field") != "", F.nanvl(F.col("field").try_cast("double"), F.lit(None).cast("double")))
    return rows.where("name IS NOT NULL").select(
        F.lit(site).alias(SITE), "ts", (F.col("name") if rename is None else rename).alias("variable"), value.alias("value"), "file_name")


def stem() -> Column:
    return F.split("file_name", r"\.")[0]


def update_registry(registry: DataFrame, readings: DataFrame, site: str) -> DataFrame:
    """Registry of read files with the time span of each; known files keep their row."""
    spans = readings.groupBy("file_name").agg(F.min("ts").alias("start_datetime"), F.max("ts").alias("end_datetime"))
    fresh = spans.join(registry, "file_name", "left_anti").select(
        F.lit(site).alias(SITE), "file_name", "start_datetime", "end_datetime")
    return registry.select(SITE, "file_name", "start_datetime", "end_datetime").unionByName(fresh)


def files_since(registry: DataFrame, site: str, since: str) -> DataFrame:
    return registry.where((F.col(SITE) == site) & (F.col("start_datetime") >= F.lit(since).cast("timestamp_ntz"))).select("file_name")

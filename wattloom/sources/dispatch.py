"""One entry for every kind of landed input."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.sources import files, logger_csv, payloads

# Default time column and format per kind.
TIME_DEFAULTS = {
    "csv": ("DateTime", "yyyy/MM/dd HH:mm:ss"), "csv_mb": ("time(UTC)", "yyyy/MM/dd HH:mm:ss"),
    "csv_dent": ("time_pt", "yyyy-MM-dd HH:mm:ss"), "csv_flow": ("time_pt", "yyyy-MM-dd HH:mm:ss"),
    "csv_msa": ("time_pt", "yyyy-MM-dd HH:mm:ss"), "csv_egauge": ("time_pt", "yyyy-MM-dd HH:mm:ss"),
    "csv_small_planet": ("time_pt", "yyyy-MM-dd HH:mm:ss"), "json": ("time", "yyyy/MM/dd HH:mm:ss"),
    "api_tb": ("time_pt", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "api_skycentrics": ("time_pt", "yyyy-MM-dd HH:mm:ss"),
    "api_fm": ("time_pt", "yyyy-MM-dd HH:mm:ss"), "api_licor": ("time_pt", "yyyy-MM-dd HH:mm:ss"),
    "api_bluedot": ("time_pt", "yyyy-MM-dd HH:mm:ss"),
}


def time_defaults(kind: str, column: str | None = None, form: str | None = None, use_defaults: bool = True) -> tuple[str | None, str | None]:
    if not use_defaults:
        return column, form
    if kind not in TIME_DEFAULTS:
        raise ValueError(f"{kind} is not a recognized kind; expected one of {', '.join(TIME_DEFAULTS)}")
    return TIME_DEFAULTS[kind]


def read_raw(
    spark: SparkSession, kind: str, path, site: str, *, start: str | None = None, end: str | None = None,
    prefix: str = "", name_start: int = files.NAME_DATE_START, name_end: int = files.NAME_DATE_END,
    name_format: str = files.NAME_DATE_FORMAT, zone: str = "US/Pacific", rules: DataFrame | None = None,
    keep_undated: bool = False, **options,
) -> DataFrame:
    """Readings of all files of a kind under ``path``, pruned by the date in their names.

    The pruning is a filter on the file's metadata. Hex-named device files start strictly after
    ``start``; all others start at it. Files without a date in their name go, or stay with ``keep_undated``.
    """
    if kind not in TIME_DEFAULTS and kind not in logger_csv.PARSERS:
        time_defaults(kind)
    if kind.startswith("api_"):
        landed = payloads.read_payloads(spark, path, site)
        return payloads.PARSERS[kind](landed, zone) if kind == "api_skycentrics" else payloads.PARSERS[kind](landed)
    def wanted(moment, strict: bool = False):
        return F.coalesce(files.within(moment, start, end, strict), F.lit(keep_undated))

    dated = lambda name: wanted(files.name_date(name, name_start, name_end, name_format))
    if kind == "json":
        return payloads.read_sensor_files(
            spark, path, site, zone, prefix=prefix, keep=None if start is None and end is None else dated, **options)
    lines = files.read_lines(spark, path, prefix=prefix)
    name = F.col("file_name")
    if start is not None or end is not None:
        if kind == "csv_mb":
            lines = lines.where(wanted(files.name_hex_epoch(name), strict=True))
        elif kind == "csv_nclarity":
            day = files.sliced(name, files.DAILY_NAME_START, files.DAILY_NAME_END).try_cast("timestamp_ntz")
            lines = lines.where(wanted(day))
        else:
            lines = lines.where(dated(name))
    if kind in ("csv_msa", "csv_egauge"):
        options["zone"] = zone
    if kind == "csv_small_planet":
        if rules is None:
            raise ValueError("csv_small_planet needs the rule table")
        options |= {"zone": zone, "rules": rules}
    return logger_csv.PARSERS[kind](lines, site, **options)

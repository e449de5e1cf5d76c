"""Small input tables: rules, event log, load-shift schedule, site information."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from wattloom.model import EVENTS, SITE
from wattloom.sources.files import parse_time

# Columns of the rule table.
RULE_COLUMNS = (
    "variable_alias string, variable_name string, site string, system string, changepoint double, ffill_length double, "
    "lower_bound double, upper_bound double, error_value double, low_alarm string, high_alarm string, fault_time string, "
    "alarm_codes string, pretty_name string"
)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rule CSV by column name, with the known columns typed and absent ones left out."""
    raw = spark.read.option("header", "true").csv(path)
    types = dict(f.strip().split(" ") for f in RULE_COLUMNS.split(","))
    return raw.select(*[F.col(c).try_cast(types.get(c, "string")).alias(c) for c in raw.columns])


def read_event_log(spark: SparkSession, path: str, site: str) -> DataFrame:
    """Event log; an empty table with the right columns when it cannot be read."""
    try:
        raw = spark.read.option("header", "true").csv(path)
        return raw.select(
            F.lit(site).alias(SITE), parse_time(F.col("start_time_pt")).alias("start_time_pt"),
            parse_time(F.col("end_time_pt")).alias("end_time_pt"), "event_type", "event_detail")
    except AnalysisException:
        return spark.createDataFrame([], EVENTS)


def schedule(raw: DataFrame, site: str, seq: str = "seq") -> DataFrame:
    """Rows ``(date, startTime, endTime, event, seq)`` to half-open intervals."""
    at = lambda c: parse_time(F.concat_ws(" ", "date", c))
    return raw.select(F.lit(site).alias(SITE), "event", at("startTime").alias("start"), at("endTime").alias("end"),
                      F.col(seq).cast("bigint").alias("seq"))


def read_schedule(spark: SparkSession, path: str, site: str) -> DataFrame:
    """Load-shift file; rows keep their file order as ``seq``."""
    raw = spark.read.option("header", "true").csv(path)
    return schedule(raw.withColumn("seq", F.monotonically_increasing_id()), site)


def read_site_table(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    """Site or air-flow information; the line after the header is a comment and is dropped."""
    raw = spark.read.option("header", "true").csv(path)
    placed = raw.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
                              "_id": F.monotonically_increasing_id()})
    # the comment line is the first row of each file's first block
    comments = placed.where("_block = 0").groupBy("_file").agg(F.min("_id").alias("_comment"))
    kept = placed.join(comments, "_file", "left").where("_block <> 0 OR _id <> _comment").drop("_file", "_block", "_id", "_comment").dropna("all")
    return kept if site is None else kept.where(F.col("site") == site)

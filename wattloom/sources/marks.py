"""What has been stored: high-water marks, point lookups and the merge with new pulls."""

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.times import floor_time, step
from wattloom.model import SITE, TS

# Fixed value: the mark of a site without data.
NO_DATA_MARK = "2000-01-09 23:59:00"


def last_full_day(stored: DataFrame, sites: DataFrame, default: str = NO_DATA_MARK) -> DataFrame:
    """End of the last full stored day per site, as ``mark``: one max per site."""
    newest = stored.groupBy(SITE).agg(F.max(TS).alias("_t"))
    ends = F.date_format("_t", "HH:mm") == "23:59"
    mark = F.when(ends, F.col("_t")).otherwise(floor_time(F.col("_t"), "DAY") - step("MINUTE"))
    return sites.select(SITE).join(newest, SITE, "left").select(
        SITE, F.coalesce(mark, F.lit(default).cast("timestamp_ntz")).alias("mark"))


def row_at(stored: DataFrame, moment) -> DataFrame:
    """Stored rows of one moment; the comparison is pushed to the scan."""
    return stored.where(F.col(TS) == F.lit(moment).cast("timestamp_ntz"))


def merge_history(stored: DataFrame, pulled: DataFrame, marks: DataFrame) -> DataFrame:
    """Stored rows up to each site's mark, followed by pulled rows after it."""
    old = stored.join(marks, SITE, "left").where(F.col("mark").isNull() | (F.col(TS) <= F.col("mark"))).drop("mark")
    new = pulled.join(marks, SITE, "left").where(F.col("mark").isNull() | (F.col(TS) > F.col("mark"))).drop("mark")
    return old.unionByName(new, allowMissingColumns=True)

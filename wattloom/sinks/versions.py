"""Tables in parts whose loads become visible by one small write.

``<path>/data/<load>/part=<p>`` holds the rows of a part as one load left them, ``<path>/manifest/version=<n>`` the list of parts that make
up a version, each with its folder and its reach, a time that later loads may prune by. A load writes new folders for the parts it
changes, beside the old ones, and then the next list. Until that file is there, readers see the version before; a load that fails in
between leaves nothing but folders that no list names. A part without rows is left out of the list.
"""

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

ENTRY = "part string, folder string, reach timestamp_ntz, version int, load string"
PART = "part"


class Conflict(RuntimeError):
    """Another load has written the same version."""


class Entry(NamedTuple):
    part: str
    folder: str
    reach: object
    version: int
    load: str


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The parts of the latest version; a table has as many as it has months."""
    try:
        lists = spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(f"{path}/manifest")
        newest = lists.agg(F.max("version")).first()[0]
    except AnalysisException:
        return []
    found = [Entry(*r) for r in lists.where(F.col("version") == F.lit(newest)).select("part", "folder", "reach", "version", "load").collect()]
    loads = {e.load for e in found}
    winner = min(loads, default=None)  # of two loads that wrote a version at once, the same one for every reader
    return sorted(e for e in found if e.load == winner)


def read(spark: SparkSession, chosen: list[Entry], schema: str) -> DataFrame:
    """The rows of some parts; nothing else is listed or opened."""
    folders = [f"{e.folder}/{PART}={e.part}" for e in chosen if e.folder]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def month(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def write(rows: DataFrame, path: str, part: Column, reach: Column, old: list[Entry], replaced: set[str]) -> int:
    """Write ``rows`` as new folders of the parts they are in and commit them with the other parts of ``old``; gives the new version.

    ``rows`` must hold all that shall be in the parts of ``replaced``.
    """
    spark, load = rows.sparkSession, uuid.uuid4().hex
    folder = f"{path}/data/{load}"
    dated = rows.withColumn(PART, part)
    spark.sql(f"SELECT /*+ REBALANCE({PART}) */ * FROM {{dated}}", dated=dated).write.partitionBy(PART).parquet(folder)
    made = spark.read.schema(f"{_schema(rows)}, {PART} string").parquet(folder).groupBy(PART).agg(F.max(reach).alias("reach")).collect()
    version = max((e.version for e in old), default=0) + 1
    new = [Entry(r[PART], folder, r["reach"], version, load) for r in made]
    fresh = {e.part for e in new}
    kept = [e._replace(version=version, load=load) for e in old if e.part not in replaced | fresh]
    commit(spark, path, kept + new or [Entry("", "", None, version, load)])
    return version


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)


def commit(spark: SparkSession, path: str, listed: list[Entry]) -> None:
    """Make a list of parts the newest version: one file of one task. Loses to a load that wrote the same version first."""
    version, load = listed[0].version, listed[0].load
    # the version also is in the rows, so the folder's name need not be read
    spark.createDataFrame(listed, ENTRY).coalesce(1).write.json(f"{path}/manifest/v{version:08d}-{load}")
    now = entries(spark, path)
    if now and now[0].version == version and now[0].load != load:
        raise Conflict(f"{path}: version {version} was written by another load")

"""Shared helpers: words, shared storage, size-checked joins."""

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattloom.session import shared_folder

#: A word is a run of characters outside these.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Rows of one id column that may be broadcast: at most 16 bytes each, 16 MB in all.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, on shared storage, so that a lost executor costs no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: shorter than a checkpoint, and as safe."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Rows of an Arrow batch where the session has Spark's own default, as texts can be long.
BATCH_ROWS = 1000
SPARK_BATCH_ROWS = "10000"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and get batches that fit long texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == SPARK_BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def small_enough(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` with a broadcast hint if it has at most ``rows`` rows; beyond that Spark shuffles the join."""
    return F.broadcast(ids) if ids.limit(rows + 1).count() <= rows else ids


def slices(lengths, limit: int):
    """Ranges of consecutive items whose lengths sum to at most ``limit``; a longer item is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def filter_rows(df: DataFrame, text: str, judge) -> DataFrame:
    """Rows for which ``judge()``, made once per task, says true; it is given lists of texts. All columns pass as they are."""
    place = df.columns.index(text)

    def run(batches):
        import pyarrow as pa

        keep = judge()
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)

"""Session defaults for local runs; a cluster passes its own configuration."""

import os
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "wattloom", cores: int | str = "*", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else a folder of the warehouse.

    A warehouse on a local disk is shared on a local master only, so elsewhere one of the settings must name shared storage.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_shared"


def cut_lineage(df, eager: bool = True):
    """Checkpoint to the folder named by ``spark.checkpoint.dir``, or to the one that ``shared_folder`` gives."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)


def settled_from(spark, name: str, make):
    """``make(folder)`` with a new shared folder: its result is checkpointed, and the folder removed."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        return cut_lineage(make(folder))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

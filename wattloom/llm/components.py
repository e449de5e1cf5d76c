"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to its smallest one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node sends itself and its smaller neighbours to its smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
        least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges of integer nodes to ``(node, root)``, root the smallest node of the component; roots have no row.

    Loops and repeated edges don't matter; an edge with a null end is ignored.
    """
    now = settle(edges.select("u", "v").where("u <> v").distinct())
    mark = None
    while True:
        now = settle(_small_star(_large_star(now).distinct()).distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen

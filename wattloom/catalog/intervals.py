"""Interval queries: orders as intervals of one to three weeks per customer."""

from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import table
from wattloom.functions.times import step
from wattloom.operators import intervals

SPANS_SQL = """SELECT o_custkey AS key, o_orderdate AS start, o_orderdate + to_days(CAST(o_orderkey % 20 + 1 AS INT)) AS "end",
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 3 WHEN '3' THEN 2 ELSE 1 END AS certainty FROM orders"""


def _spans(spark, sf):
    level = F.expr("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 3 WHEN '3' THEN 2 ELSE 1 END")
    length = F.make_dt_interval((F.pmod("o_orderkey", F.lit(20)) + 1).cast("int"))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + length).alias("end"), level.alias("certainty"))


def _merge_sql(keys: str, gap: str) -> str:
    return f"""WITH s AS ({SPANS_SQL}), r AS (SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY start, "end"
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
        g AS (SELECT *, sum(CASE WHEN {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS grp FROM r)
        SELECT {keys}, min(start) AS start, max("end") AS "end" FROM g GROUP BY {keys}, grp"""


@query("merge_intervals", _merge_sql("key, certainty", "start <= reach + INTERVAL 1 MINUTE"))
def merge_intervals(spark, sf):
    near = F.col("start") <= F.col("_reach") + step("MINUTE")
    return intervals.merge_touching(
        _spans(spark, sf), ["key", "certainty"], near, segment=F.date_trunc("YEAR", "start"))


@query("alarm_sessions", _merge_sql("key", "start - reach < INTERVAL 4 DAY"))
def alarm_sessions(spark, sf):
    return intervals.sessions(_spans(spark, sf), ["key"])


@query("certainty_coverage", f"""
    WITH s AS ({SPANS_SQL}), p AS (SELECT key, start AS t0 FROM s UNION SELECT key, "end" FROM s),
    e AS (SELECT key, t0, lead(t0) OVER (PARTITION BY key ORDER BY t0) AS until FROM p),
    c AS (SELECT e.key, e.t0, e.until, coalesce(max(certainty), 0) AS level FROM e
          LEFT JOIN s ON e.key = s.key AND s.start <= e.t0 AND s."end" >= e.until GROUP BY 1, 2, 3),
    g AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t0) - row_number() OVER (PARTITION BY key, level ORDER BY t0) AS grp
          FROM c WHERE until IS NOT NULL)
    SELECT key, min(t0) AS start, max(until) AS "end", CAST(level AS INTEGER) AS certainty FROM g WHERE level > 0 GROUP BY key, level, grp""")
def certainty_coverage(spark, sf):
    return intervals.certainty_coverage(_spans(spark, sf), ["key"])

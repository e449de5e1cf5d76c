"""Curves: linear fits as aggregates, and interpolation as a join on segments."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.model import ratio

# Air density correction by elevation in feet.
ALTITUDE_CORRECTION = (
    (0, 1.00), (1000, 0.97), (2000, 0.93), (3000, 0.89), (4000, 0.87), (5000, 0.84), (6000, 0.80),
    (7000, 0.77), (8000, 0.75), (9000, 0.72), (10000, 0.69), (11000, 0.66), (12000, 0.63),
)
ALTITUDE_FLOOR = 1000


def fit_line(df: DataFrame, y: str, x: str, by: list[str] | None = None) -> DataFrame:
    """Least-squares ``slope`` and ``intercept`` per group; one partial aggregate, no iteration."""
    return df.groupBy(*(by or [])).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def altitude_factor(elevation: Column) -> Column:
    """Fitted air correction; 1 below the floor or where the elevation is unknown.

    The fit over the fixed table is a constant, so it is folded here rather than in a job.
    """
    n = len(ALTITUDE_CORRECTION)
    mean_x = sum(x for x, _ in ALTITUDE_CORRECTION) / n
    mean_y = sum(y for _, y in ALTITUDE_CORRECTION) / n
    slope = sum((x - mean_x) * (y - mean_y) for x, y in ALTITUDE_CORRECTION) / sum(
        (x - mean_x) ** 2 for x, _ in ALTITUDE_CORRECTION
    )
    fitted = F.lit(mean_y - slope * mean_x) + slope * elevation
    return F.when(elevation >= ALTITUDE_FLOOR, fitted).otherwise(F.lit(1.0))


def curve_segments(points: DataFrame, by: tuple[str, ...] = ("curve",)) -> DataFrame:
    """Knots ``(curve, x, y)`` to segments ``(curve, x0, x1, y0, y1)``.

    A curve is a calibration table of one sensor model, so its window is short.
    """
    w = Window.partitionBy(*by).orderBy("x")
    return (
        points.withColumns({"x1": F.lead("x").over(w), "y1": F.lead("y").over(w)})
        .where("x1 IS NOT NULL")
        .select(*by, F.col("x").alias("x0"), "x1", F.col("y").alias("y0"), "y1")
    )


def apply_curve(df: DataFrame, column: str, segments: DataFrame, out: str, width: float) -> DataFrame:
    """Piecewise-linear value of ``df.column`` on the curve named by ``df.curve``.

    ``width`` cuts the x axis into cells. Segments are repeated for the cells they touch, which
    gives the range join an equality key ``(curve, cell)``: it needs no nested loop and may be
    broadcast or shuffled by its size. A value outside the curve gives NULL. The upper end of a
    curve belongs to its last segment.
    """
    value = F.col(column)
    last = Window.partitionBy("curve").orderBy(F.desc("x1"))
    cells = (
        segments.withColumn("_closed", F.row_number().over(last) == 1)
        .withColumn("_cell", F.explode(F.sequence(
            F.floor(F.col("x0") / width).cast("bigint"), F.floor(F.col("x1") / width).cast("bigint"))))
    )
    keyed = df.withColumn("_cell", F.floor(value / width).cast("bigint"))
    inside = (value >= F.col("c.x0")) & (
        (value < F.col("c.x1")) | (F.col("c._closed") & (value == F.col("c.x1")))
    )
    joined = keyed.alias("d").join(
        cells.alias("c"),
        (F.col("d.curve") == F.col("c.curve")) & (F.col("d._cell") == F.col("c._cell")) & inside,
        "left",
    )
    interpolated = F.col("c.y0") + (F.col("c.y1") - F.col("c.y0")) * ratio(
        value - F.col("c.x0"), F.col("c.x1") - F.col("c.x0")
    )
    kept = [F.col(f"d.{n}") for n in df.columns if n != out]
    return joined.select(*kept, interpolated.alias(out))


def apply_calibration(df: DataFrame, column: str, forward: DataFrame, backward: DataFrame,
                      forward_width: float, backward_width: float) -> DataFrame:
    """Pass a reading through two curves, e.g. temperature to resistance to temperature."""
    through = apply_curve(df, column, forward, "_mid", forward_width)
    return apply_curve(through, "_mid", backward, column, backward_width).drop("_mid")

"""Unit conversions. Names say what the arithmetic does."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Conversion constants and the sky-condition codes of hourly station records.
BTUH_PER_KW = 3412
GALLONS_PER_LITRE = 0.2641729
KNOTS_PER_MPS = 1.9438445
WATER_FACTOR = 8.33
SKY_CONDITIONS = {
    0: "None, SKC or CLR",
    1: "One okta - 1/10 or less but not zero",
    2: "Two oktas - 2/10 - 3/10, or FEW",
    3: "Three oktas - 4/10",
    4: "Four oktas - 5/10, or SCT",
    5: "Five oktas - 6/10",
    6: "Six oktas - 7/10 - 8/10",
    7: "Seven oktas - 9/10 or more but not 10/10, or BKN",
    8: "Eight oktas - 10/10, or OVC",
    9: "Sky obscured, or cloud amount cannot be estimated",
    10: "Partial obscuration",
    11: "Thin scattered",
    12: "Scattered",
    13: "Dark scattered",
    14: "Thin broken",
    15: "Broken",
    16: "Dark broken",
    17: "Thin overcast",
    18: "Overcast",
    19: "Dark overcast",
}


def celsius_tenths_to_fahrenheit(v: Column) -> Column:
    return 32 + (v / 10) * 9 / 5


def celsius_to_fahrenheit(v: Column) -> Column:
    return 32 + 1.8 * v


def fahrenheit_to_celsius(v: Column) -> Column:
    return (v - 32) * 5 / 9


def btuh_to_kw(v: Column) -> Column:
    return v / BTUH_PER_KW


def litres_to_gallons(v: Column) -> Column:
    return v * GALLONS_PER_LITRE


def tenth(v: Column) -> Column:
    return v / 10


def mps_tenths_to_knots(v: Column) -> Column:
    return KNOTS_PER_MPS * v / 10


def precipitation_tenths(v: Column) -> Column:
    """Tenths to units; the trace marker -1 is kept."""
    return F.when(v == -1, v.cast("double")).otherwise(v / 10)


def per_minute_to_per_hour(v: Column) -> Column:
    return v * 60


def btu_per_hour_to_kwh_per_minute(v: Column) -> Column:
    return v / (60 * 3.412)


def water_heat_kbtuh(gpm: Column, delta_f: Column) -> Column:
    return 60 * WATER_FACTOR * gpm * delta_f / 1000


def water_heat_kw(gpm: Column, delta_f: Column) -> Column:
    return 60 * WATER_FACTOR * gpm * delta_f / 3412


def sky_condition(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SKY_CONDITIONS.items() for x in pair])
    return F.try_element_at(table, code.cast("int"))


UNIT_RULES = {
    "c_to_f": celsius_to_fahrenheit,
    "btuhr_to_kw": btuh_to_kw,
    "l_to_g": litres_to_gallons,
}


def convert_columns(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Convert named wide columns; absent and non-numeric columns are left alone."""
    numeric = {n for n, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint")}
    todo = {c: UNIT_RULES[r](F.col(f"`{c}`")) for c, r in rules.items() if c in numeric}
    return df.withColumns(todo) if todo else df

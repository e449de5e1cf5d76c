"""Metrics of hot-water plants: tank zones, stored volume, daily heat and efficiency."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.times import floor_time
from wattloom.functions.units import btu_per_hour_to_kwh_per_minute, per_minute_to_per_hour, water_heat_kbtuh
from wattloom.model import SITE, TS, VALUE, VARIABLE, differs, ratio

# Zone names by the sensor number in a name, tank sensors from top to bottom, the
# usable temperature, and the one irregular energy name.
ZONES = {"Temp1": "Temp_top", "Temp2": "Temp_midtop", "Temp3": "Temp_mid", "Temp4": "Temp_midbottom", "Temp5": "Temp_bottom"}
TANK = ("Temp_PrimaryStorageOutTop", "Temp_top", "Temp_midtop", "Temp_mid", "Temp_midbottom", "Temp_bottom")
USABLE_F = 120
IRREGULAR_ENERGY = {"PowerMeter_SkidAux_Power": "PowerMeter_SkidAux_Energty"}
CUMULATIVE_END = "[^BTU]$"


def _mean_known(columns: Sequence[str]) -> Column:
    if not columns:
        return F.lit(None).cast("double")
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in columns), F.lit(0.0))
    known = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in columns), F.lit(0))
    return F.when(known > 0, total / known)


def zone_temperatures(df: DataFrame) -> DataFrame:
    """Mean of parallel tanks per zone, over the columns whose name contains ``Temp1``..``Temp5``."""
    return df.withColumns({
        zone: _mean_known([c for c in df.columns if mark in c]) for mark, zone in ZONES.items()})


def storage_volume(df: DataFrame, location: Sequence[float], total_gallons: float) -> DataFrame:
    """``Vol120``, ``ZoneTemp120`` and ``Vol_Equivalent_to_120`` from six tank temperatures.

    ``location`` holds the relative heights of the zone borders from top to bottom; the zone between
    two borders holds its share of the total. Array functions over the six values, no UDF.
    """
    volumes = [(a - b) * total_gallons for a, b in zip(location, location[1:])]
    if len(volumes) < len(TANK) - 1:
        raise ValueError(f"needs at least {len(TANK)} zone borders")
    bottom = volumes[5] if len(volumes) > 5 else None
    full = ", ".join(f"double({v!r})" for v in volumes[:5])
    cold = F.expr(f"array_position(transform(_t, t -> coalesce(t < {USABLE_F}, false)), true)").cast("int")
    staged = df.withColumn("_t", F.array(*[F.col(c).cast("double") for c in TANK])).withColumn("_k", cold).withColumn(
        "_v", F.expr(f"array({full})"))
    # zone k-1 (1-based) lies between the last warm and the first cold sensor
    inside = F.expr(f"CASE WHEN _k >= 2 THEN try_divide(_t[_k - 2] - {USABLE_F}, _t[_k - 2] - _t[_k - 1]) * _v[_k - 2] ELSE 0D END")
    zone_temp = F.expr(f"CASE WHEN _k >= 2 THEN ({USABLE_F} + _t[_k - 2]) / 2 END")
    staged = staged.withColumns({"Vol120": inside, "ZoneTemp120": zone_temp})
    whole = F.expr("CASE WHEN _k = 0 THEN 5 ELSE _k - 2 END")
    staged = staged.withColumn("_w", whole)
    zones = "slice(sequence(1, 5), 1, greatest(_w, 0))"
    volume = F.expr(f"aggregate({zones}, 0D, (a, i) -> a + _v[i - 1])")
    heat = F.expr(f"aggregate({zones}, 0D, (a, i) -> a + (_t[i] + _t[i - 1]) / 2 * _v[i - 1])")
    last_v = F.when(F.col("_k") == 0, F.lit(bottom).cast("double")).otherwise(F.col("Vol120"))
    last_t = F.when(F.col("_k") == 0, F.expr("_t[5]")).otherwise(F.col("ZoneTemp120"))
    city = F.col("Temp_CityWater_atSkid")
    all_v, all_heat = volume + last_v, heat + last_v * last_t
    equivalent = ratio(ratio(all_heat, all_v) - city, USABLE_F - city) * all_v
    top_cold = F.expr(f"_t[0] < {USABLE_F}")
    return staged.withColumn("Vol_Equivalent_to_120", F.when(top_cold, 0.0).otherwise(equivalent)).drop("_t", "_k", "_v", "_w")


def power_energy_conflicts(df: DataFrame, margin: float = 0.0) -> DataFrame:
    """Moments where a power reading is not its energy reading times 60, by more than ``margin``.

    The two are paired by name and met in one group per moment, not by a self-join. A missing side is
    a conflict.
    """
    name = F.col(VARIABLE)
    is_energy = name.contains("Energy") & name.rlike(CUMULATIVE_END)
    is_power = name.contains("Power") & ~name.contains("Energy")
    partner = F.replace(name, F.lit("Power"), F.lit("Energy"))
    for power, energy in IRREGULAR_ENERGY.items():
        partner = F.when(name == power, energy).otherwise(partner)
    paired = df.where(is_energy | is_power).select(
        SITE, TS, VARIABLE, VALUE, is_power.alias("_power"), F.when(is_power, partner).otherwise(name).alias("energy_variable"))
    met = paired.groupBy(SITE, TS, "energy_variable").agg(
        F.max(F.when(F.col("_power"), F.col(VARIABLE))).alias("power_variable"),
        F.max(F.when(F.col("_power"), F.col(VALUE))).alias("power_value"),
        F.max(F.when(~F.col("_power"), F.col(VALUE))).alias("energy_value"),
        F.count(F.when(~F.col("_power"), 1)).alias("_n"))
    expected = per_minute_to_per_hour(F.col("energy_value"))
    checked = met.where((F.col("_n") > 0) & F.col("power_variable").isNotNull()).withColumns({
        "expected_power": expected, "difference_from_expected": F.abs(expected - F.col("power_value"))})
    off = F.col("power_value").isNull() | F.col("expected_power").isNull() | (
        differs(F.col("power_value"), F.col("expected_power")) & (F.col("difference_from_expected") > margin))
    return checked.where(off).drop("_n")


def daily_plant_heat(df: DataFrame, slice_from: str | None = None) -> DataFrame:
    """Daily mean heat flows of the plant from wide minute rows; ``slice_from`` is ``HH:MM``.

    City-water temperatures are averaged from that time of day on. One daily aggregate; the row
    formulas run before it in the same stage.
    """
    has_loop = "Flow_SecLoop" in df.columns
    c = F.col
    supply = (c("Temp_RecircSupply_MXV1") + c("Temp_RecircSupply_MXV2")) / 2
    late = F.lit(True) if slice_from is None else F.date_format(TS, "HH:mm") >= slice_from
    rows = {
        "Temp_RecircSupply_avg": supply,
        "HeatOut_PrimaryPlant": water_heat_kbtuh(c("Flow_CityWater_atSkid"), c("Temp_PrimaryStorageOutTop") - c("Temp_CityWater_atSkid")),
        "HeatOut_HW": water_heat_kbtuh(c("Flow_CityWater"), supply - c("Temp_CityWater")),
        "HeatLoss_TempMaint_MXV1": water_heat_kbtuh(c("Flow_RecircReturn_MXV1"), c("Temp_RecircSupply_MXV1") - c("Temp_RecircReturn_MXV1")),
        "HeatLoss_TempMaint_MXV2": water_heat_kbtuh(c("Flow_RecircReturn_MXV2"), c("Temp_RecircSupply_MXV2") - c("Temp_RecircReturn_MXV2")),
        "EnergyIn_SecLoopPump": c("PowerIn_SecLoopPump") / 60,
        "EnergyIn_HPWH": c("EnergyIn_HPWH"),
    }
    if has_loop:
        rows["HeatOut_SecLoop"] = water_heat_kbtuh(c("Flow_SecLoop"), c("Temp_SecLoopHexOutlet") - c("Temp_SecLoopHexInlet"))
    helper = {n: c(n) for n in ("Flow_CityWater", "Flow_CityWater_atSkid", "Temp_PrimaryStorageOutTop")}
    sliced = {n: F.when(late, c(n)) for n in ("Temp_CityWater_atSkid", "Temp_CityWater")}
    means = df.groupBy(SITE, floor_time(c(TS), "DAY").alias(TS)).agg(
        *[F.avg(e).alias(n) for n, e in rows.items()], *[F.avg(e).alias(f"_{n}") for n, e in (helper | sliced).items()])
    delta = c("_Temp_PrimaryStorageOutTop") - c("_Temp_CityWater_atSkid")
    primary = water_heat_kbtuh(c("_Flow_CityWater_atSkid"), delta)
    return means.withColumns({
        "HeatOut_HW_dyavg": water_heat_kbtuh(c("_Flow_CityWater"), c("Temp_RecircSupply_avg") - c("_Temp_CityWater")),
        "HeatOut_PrimaryPlant_dyavg": F.when((delta < 2) | (primary < 0), 0.0).otherwise(primary),
    }).select(SITE, TS, *rows, "HeatOut_HW_dyavg", "HeatOut_PrimaryPlant_dyavg")


def daily_cop(heat: DataFrame, fixed_loss: float, sliced: bool) -> DataFrame:
    """Five efficiency figures from :func:`daily_plant_heat`; two exist only for a time slice."""
    c, kwh = F.col, btu_per_hour_to_kwh_per_minute
    power = c("EnergyIn_HPWH") + c("EnergyIn_SecLoopPump")
    loss = kwh(c("HeatLoss_TempMaint_MXV1")) + kwh(c("HeatLoss_TempMaint_MXV2"))
    none = F.lit(None).cast("double")
    primary_day = F.when(c("EnergyIn_HPWH") <= 0.01, 0.0).otherwise(c("HeatOut_PrimaryPlant_dyavg"))
    return heat.select(
        SITE, TS,
        ratio(kwh(c("HeatOut_HW")) + loss, power).alias("COP_DHWSys"),
        (ratio(kwh(c("HeatOut_HW_dyavg")) + loss, power) if sliced else none).alias("COP_DHWSys_dyavg"),
        ratio(kwh(c("HeatOut_HW")) + kwh(F.lit(float(fixed_loss))), power).alias("COP_DHWSys_fixTMloss"),
        ratio(kwh(c("HeatOut_PrimaryPlant")), power).alias("COP_PrimaryPlant"),
        (ratio(kwh(primary_day), power) if sliced else none).alias("COP_PrimaryPlant_dyavg"))

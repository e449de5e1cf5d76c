"""Metrics of HVAC sites. Wide rows ``(site, ts, ...)``; site constants come from site tables."""

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.curves import altitude_factor, apply_curve, curve_segments, fit_line
from wattloom.functions.physics import wet_bulb_fahrenheit
from wattloom.functions.times import floor_time
from wattloom.model import SITE, TS, known
from wattloom.operators.joins import join_few
from wattloom.operators.sequences import ordered

# Site groups by name, thresholds and physical constants.
PRESSURE_OFFSET_SITES, PRESSURE_OFFSET = "MO2_", 55
METERED_FAN_SITES = "(AZ2_01|AZ2_02|MO2_|IL2_|NW2_01)"
METERED_SYSTEM_SITES = "(AZ2_03)"
METERED_PARTS_SITES = "(AZ2_04|AZ2_05)"
PA_PER_INWC = 248.84
M3_PER_OZ, WATER_DENSITY, LATENT_HEAT = 1 / 33810, 997, 2264.705
STATE_DT, STATE_POWER, STATE_ODT, STATE_IDLE = 1.5, 0.01, 65, 0.0001
AIR_FACTOR, BTUH_PER_W = 1.08, 3.412
FAN_EXPONENT = 0.3333


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("double")


def site_power(df: DataFrame) -> DataFrame:
    """Derived power columns, by the group a site's name belongs to."""
    s = F.col(SITE)
    total, fan, ah = (_or_null(df, f"Power_{n}") for n in ("OD_total1", "OD_fan1", "AH1"))
    compressor, system = (_or_null(df, f"Power_{n}") for n in ("OD_compressor1", "system1"))
    fan_sites = s.rlike(METERED_FAN_SITES)
    system_sites = ~fan_sites & s.rlike(METERED_SYSTEM_SITES)
    part_sites = ~fan_sites & ~system_sites & s.rlike(METERED_PARTS_SITES)
    drawn = total - fan
    made_total = compressor + fan
    pressure = _or_null(df, "Pressure_staticP")
    out = df.withColumns({
        "Power_OD_compressor1": F.when(fan_sites, F.when(drawn < 0, 0.0).otherwise(drawn)).otherwise(compressor),
        "Power_OD_total1": F.when(system_sites, made_total).otherwise(total),
        "Power_AH1": F.when(system_sites, system - made_total).otherwise(ah),
        "Power_system1": F.when(fan_sites | part_sites, total + ah).otherwise(system),
        "Pressure_staticP": F.when(s.rlike(PRESSURE_OFFSET_SITES), pressure + PRESSURE_OFFSET).otherwise(pressure),
    })
    return out


def mean_supply_temp(df: DataFrame) -> DataFrame:
    """Mean of the known ``Temp_SAT*`` columns."""
    names = [c for c in df.columns if "Temp_SAT" in c and c != "Temp_SATAvg"]
    known_n = sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in names), F.lit(0.0))
    return df.withColumn("Temp_SATAvg", F.when(known_n > 0, total / known_n))


def merge_pressure(df: DataFrame) -> DataFrame:
    if {"Pressure_staticInWC", "Pressure_staticPa"} <= set(df.columns):
        return df.withColumn("Pressure_staticP", F.col("Pressure_staticPa") + PA_PER_INWC * F.col("Pressure_staticInWC"))
    return df


def line_temperatures(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f"Temp_{n}_F": 9 / 5 * F.col(f"Temp_{n}_C") + 32 for n in ("LL", "SL") if f"Temp_{n}_C" in df.columns})


def condensate(df: DataFrame, sites: DataFrame, segment: Column | None = None) -> DataFrame:
    """``Condensate_kJ`` from on-time (next minus current) or from pulses; ``sites`` has the constants."""
    segment = floor_time(F.col(TS), "DAY") if segment is None else segment
    consts = sites.select(SITE, F.col("condensate_cycle_length").alias("_cycle"), F.col("condensate_oz_per_tip").alias("_tip"))
    if "Condensate_ontime" in df.columns:
        seen = ordered(df, [SITE], [TS], segment, lead={"_next": F.col("Condensate_ontime")})
        ounces = (F.col("_next") - F.col("Condensate_ontime")) / F.col("_cycle") * F.col("_tip")
    elif "Condensate_pulse_avg" in df.columns:
        seen, ounces = df, F.col("Condensate_pulse_avg") * F.col("_tip")
    else:
        return df
    heat = ounces * M3_PER_OZ * WATER_DENSITY * LATENT_HEAT / 1000
    return seen.join(consts, SITE, "left").withColumn("Condensate_kJ", heat).select(*df.columns, "Condensate_kJ")


def gas_valve_difference(df: DataFrame, sites: DataFrame, segment: Column | None = None) -> DataFrame:
    """Cumulative gas valve columns to amounts per row, only where the site heats with gas."""
    names = ["gasvalve"] if "gasvalve" in df.columns else [
        c for c in ("gasvalve_lowstage", "gasvalve_highstage") if {"gasvalve_lowstage", "gasvalve_highstage"} <= set(df.columns)]
    if not names:
        return df
    segment = floor_time(F.col(TS), "DAY") if segment is None else segment
    seen = ordered(df, [SITE], [TS], segment, lag={f"_p_{n}": F.col(n) for n in names})
    joined = seen.join(sites.select(SITE, "heating_type"), SITE, "left")
    gas = F.col("heating_type") == "gas"
    return joined.withColumns({
        n: F.when(gas, F.col(n) - F.col(f"_p_{n}")).otherwise(F.col(n)) for n in names}).select(*df.columns)


def refrigerant_charge(df: DataFrame, sites: DataFrame, saturation: DataFrame, chart: DataFrame) -> DataFrame:
    """``Refrig_charge`` by the site's metering device: subcooling for ``txv``, superheat for ``orifice``.

    ``saturation`` is ``(refrigerant, pressure, temp)``, ``sites`` has ``site, metering_device, refrigerant``,
    ``chart`` is ``(odt, wb, target)`` on rows five degrees apart. The saturation line is one fitted row
    per refrigerant, joined by name.
    """
    line = fit_line(saturation, "temp", "pressure", ["refrigerant"])
    devices = sites.select(SITE, "metering_device", "refrigerant").join(line, "refrigerant", "left")
    joined = df.join(devices, SITE, "left")
    sat = F.col("slope") * F.col("Pressure_SL_psi") + F.col("intercept")
    subcooling = sat - (_or_null(df, "Temp_LL_C") * 9 / 5 + 32)
    have = {"Temp_ODT", "Temp_RAT", "Humidity_RARH", "Pressure_SL_psi", "Temp_SL_C"} <= set(df.columns)
    if not have:
        return joined.withColumn(
            "Refrig_charge", F.when(F.col("metering_device") == "txv", known(subcooling))).select(*df.columns, "Refrig_charge")
    rows = chart.select(F.col("odt").cast("bigint").cast("string").alias("curve"), F.col("wb").alias("x"), F.col("target").alias("y"))
    segments = curve_segments(rows)
    low, high = F.floor(F.col("Temp_ODT") / 5) * 5, F.ceil(F.col("Temp_ODT") / 5) * 5
    wet = joined.withColumns({"_wb": wet_bulb_fahrenheit(F.col("Temp_RAT"), F.col("Humidity_RARH")),
                              "_sat": sat, "_sub": subcooling, "curve": low.cast("string")})
    first = apply_curve(wet, "_wb", segments, "_t1", 5).withColumn("curve", high.cast("string"))
    both = apply_curve(first, "_wb", segments, "_t2", 5)
    target = F.when(low == high, F.col("_t1")).otherwise(
        F.col("_t1") + (F.col("_t2") - F.col("_t1")) * (F.col("Temp_ODT") - low) / 5)
    superheat = F.col("Temp_SL_C") * 9 / 5 + 32 - F.col("_sat") - target
    charge = F.when(F.col("metering_device") == "txv", F.col("_sub")).when(F.col("metering_device") == "orifice", superheat)
    return both.withColumn("Refrig_charge", known(charge)).select(*df.columns, "Refrig_charge")


def event_state(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Add ``HVAC`` (heat, cool, circ) per event from the event's mean readings; event 0 is dropped.

    The event means are a partial aggregate; a hot event's rows meet one state row on the way back.
    """
    names = ("Temp_ODT", "Temp_RAT", "Temp_SATAvg", "Power_OD_total1")
    means = df.where("event_ID <> 0").groupBy(SITE, "event_ID").agg(*[F.avg(n).alias(n) for n in names])
    dt = F.col("Temp_SATAvg") - F.col("Temp_RAT")
    od = F.col("Power_OD_total1")
    by_weather = F.when(F.col("Temp_ODT") > STATE_ODT, "cool").otherwise("heat")
    by_dt = F.when(dt >= STATE_DT, "heat").when(dt <= -STATE_DT, "cool").otherwise("circ")
    guess = F.when(dt.isNotNull(), by_dt).otherwise(by_weather)
    gas = F.when(od.isNull(), guess).when(od >= STATE_POWER, "cool").when(od <= STATE_IDLE, "circ").otherwise(guess)
    electric = (
        F.when(od.isNull(), guess).when(od < STATE_POWER, "circ").when(dt.isNull(), by_weather)
        .when(dt >= STATE_DT, "heat").otherwise("cool")
    )
    states = means.join(sites.select(SITE, "heating_type"), SITE, "left").select(
        SITE, "event_ID", F.when(F.col("heating_type") == "gas", gas).otherwise(electric).alias("HVAC"))
    return df.join(states, [SITE, "event_ID"])


def airflow(df: DataFrame, cfm: DataFrame, sites: DataFrame) -> DataFrame:
    """``Cfm_Calc``: the mean measured flow of the mode, or the cube root of fan power in watts.

    ``cfm`` is ``(site, mode, ID_blower_cfm, use_fan_curve)``. The furnace's own power is removed on
    sites that heat at all.
    """
    modes = F.array(*[F.struct(F.lit(m).alias("m"), F.col("mode").contains(m).alias("hit")) for m in ("circ", "heat", "cool")])
    flows = cfm.select(SITE, "ID_blower_cfm", F.explode(F.filter(modes, lambda x: x["hit"])).alias("x")).groupBy(
        SITE, F.col("x.m").alias("HVAC")).agg(F.avg("ID_blower_cfm").alias("_flow"))
    curves = cfm.groupBy(SITE).agg(F.max(F.upper(F.col("use_fan_curve").cast("string")) == "TRUE").alias("_curve"))
    heats = df.groupBy(SITE).agg(F.bool_or(F.col("HVAC") == "heat").alias("_heats"))
    joined = (
        join_few(df.join(flows, [SITE, "HVAC"], "left").join(curves, SITE, "left"), heats, [SITE], "left")
        .join(sites.select(SITE, F.col("furn_misc_power").alias("_furn")), SITE, "left")
    )
    watts = 1000 * (F.col("Power_AH1") - F.when(F.col("_heats"), F.coalesce("_furn", F.lit(0.0))).otherwise(0.0))
    by_fan = F.when(watts >= 0, F.cbrt(watts))
    return joined.withColumn(
        "Cfm_Calc", F.when(F.col("_curve"), by_fan).otherwise(F.coalesce("_flow", F.lit(0.0)))).select(*df.columns, "Cfm_Calc")


def hvac_cop(df: DataFrame, sites: DataFrame) -> DataFrame:
    """``cop`` of cooling: air-side output over system power; 0 in heat and circulation."""
    joined = df.join(sites.select(SITE, F.col("elev").alias("_elev")), SITE, "left")
    out = (F.col("Temp_SAT1") - F.col("Temp_RAT")) * F.col("Cfm_Calc") * AIR_FACTOR * altitude_factor(F.col("_elev"))
    btuh = F.when(F.col("HVAC").isin("heat", "circ"), 0.0).otherwise(out)
    cop = F.abs(F.try_divide(btuh / BTUH_PER_W / 1000, F.col("Power_system1")))
    return joined.withColumn("cop", F.coalesce(known(cop), F.lit(0.0))).select(*df.columns, "cop")


def air_correction(sites: DataFrame) -> DataFrame:
    return sites.select(SITE, "elev", altitude_factor(F.col("elev")).alias("air_corr"))


def fan_curves(cfm: DataFrame, sites: DataFrame) -> DataFrame:
    """Per site intercept ``a`` and slope ``b`` of flow over ``watts^0.3333 - 1``."""
    joined = cfm.join(sites.select(SITE, (F.col("furn_misc_power") * 1000).alias("_furn")), SITE, "left")
    removed = F.when(F.col("mode").contains("heat"), F.coalesce("_furn", F.lit(0.0))).otherwise(0.0)
    x = F.pow(F.col("ID_blower_rms_watts") - removed, F.lit(FAN_EXPONENT)) - 1
    fitted = fit_line(joined.withColumn("_x", known(x)), "ID_blower_cfm", "_x", [SITE])
    return fitted.select(SITE, F.col("intercept").alias("a"), F.col("slope").alias("b"))

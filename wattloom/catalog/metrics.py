"""Metric queries: line items and event slots stand for sensor columns."""

from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.tables import EVENT_TYPES, grain_readings, grain_sql, rounded, table
from wattloom.functions import curves, physics
from wattloom.model import SITE, TS, VALUE, VARIABLE, literal_table, to_wide
from wattloom.operators import hot_water, hvac

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)


def _lines(spark, sf):
    return table(spark, sf, "lineitem")


@query("three_phase_power", f"""
    SELECT {KEY_SQL}, round((l_quantity + l_discount * 100 + l_tax * 100) / 3 * 208 * 1 * sqrt(3) / 1000, 6) AS kw FROM lineitem""")
def three_phase_power(spark, sf):
    kw = physics.three_phase_power(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100)
    return _lines(spark, sf).select(*KEY, rounded(kw).alias("kw"))


@query("heat_output", f"""
    SELECT {KEY_SQL}, round(CASE WHEN 500 * l_quantity * (l_extendedprice / 1000 - 40) > 0
        THEN 500 * l_quantity * (l_extendedprice / 1000 - 40) ELSE 0 END / 3412, 5) AS kw FROM lineitem""")
def heat_output(spark, sf):
    kw = physics.heat_output(F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.lit(40))
    return _lines(spark, sf).select(*KEY, rounded(kw, 5).alias("kw"))


@query("relative_humidity", f"""
    WITH t AS (SELECT {KEY_SQL}, (l_quantity + 40 - 32) * 5 / 9 AS t, (l_quantity + 40 - l_tax * 500 + 3 - 32) * 5 / 9 AS d FROM lineitem)
    SELECT {KEY_SQL}, round(least(greatest(pow(10, 7.5 * d / (d + 237.3)) / pow(10, 7.5 * t / (t + 237.3)) * 100, 0), 100), 6) AS rh FROM t""")
def relative_humidity(spark, sf):
    temp = F.col("l_quantity") + 40
    rh = physics.relative_humidity(temp, temp - F.col("l_tax") * 500 + 3)
    return _lines(spark, sf).select(*KEY, rounded(rh).alias("rh"))


@query("cop_1", f"""
    SELECT {KEY_SQL}, round(CASE WHEN l_tax = 0 THEN CASE WHEN l_quantity + 1.5 > 0 THEN 'infinity'::DOUBLE END
        ELSE (l_quantity + 1.5) / l_tax END, 6) AS cop FROM lineitem""")
def cop_1(spark, sf):
    return _lines(spark, sf).select(*KEY, rounded(physics.cop_boundary(F.col("l_quantity"), 1.5, F.col("l_tax"))).alias("cop"))


WIDE = ("SELECT site, ts, " + ", ".join(f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in EVENT_TYPES)
        + f" FROM ({grain_sql()}) GROUP BY 1, 2")


def _wide(spark, sf):
    return to_wide(grain_readings(spark, sf), EVENT_TYPES)


@query("cop_2", f"""
    SELECT site, ts, round(3.1 * ((click + error) / purchase) + 1.2 * (view / purchase), 6) AS cop FROM ({WIDE}) WHERE purchase > 0""")
def cop_2(spark, sf):
    df = _wide(spark, sf).where("purchase > 0").select(
        SITE, TS, F.col("click").alias("PowerIn_HPWH1"), F.col("error").alias("PowerIn_SecLoopPump"),
        F.col("view").alias("PowerIn_SwingTank1"), F.col("purchase").alias("PowerIn_Total"))
    return df.select(SITE, TS, rounded(physics.cop_weighted(df.columns, F.lit(3.1), 1.2)).alias("cop"))


@query("cop_derate", """
    SELECT p_partkey, round(p_retailprice * CASE WHEN p_size < 16 THEN 0.88 WHEN p_size < 20 THEN 0.9 WHEN p_size < 24 THEN 0.92
        WHEN p_size < 28 THEN 0.94 WHEN p_size < 32 THEN 0.96 ELSE 0.98 END, 4) AS cop FROM part WHERE p_size >= 12""")
def cop_derate(spark, sf):
    parts = table(spark, sf, "part").where("p_size >= 12")
    return parts.select("p_partkey", F.round(F.col("p_retailprice") * physics.cop_derate(F.col("p_size")), 4).alias("cop"))


@query("zone_temperatures", f"""
    SELECT site, ts, round((coalesce(click, 0) + coalesce(view, 0)) / nullif((click IS NOT NULL)::INT + (view IS NOT NULL)::INT, 0), 6) AS Temp_top,
        round(error, 6) AS Temp_mid FROM ({WIDE})""")
def zone_temperatures(spark, sf):
    df = _wide(spark, sf).select(
        SITE, TS, F.col("click").alias("Tank1_Temp1"), F.col("view").alias("Tank2_Temp1"), F.col("error").alias("Tank1_Temp3"))
    out = hot_water.zone_temperatures(df)
    return out.select(SITE, TS, rounded("Temp_top").alias("Temp_top"), rounded("Temp_mid").alias("Temp_mid"))


LOCATION = (1.0, 0.9, 0.7, 0.5, 0.3, 0.15, 0.0)
TANK_SQL = "SELECT vec_id, " + ", ".join(
    f"120 + 200 * CAST(embedding[{i + 1}] AS DOUBLE) AS t{i}" for i in range(6)) + ", 50 + 10 * CAST(embedding[7] AS DOUBLE) AS cw FROM embeddings"
_v = [(a - b) * 500 for a, b in zip(LOCATION, LOCATION[1:])]
_case_v120 = "CASE " + " ".join(
    f"WHEN {' AND '.join(f't{j} >= 120' for j in range(k))} AND t{k} < 120 THEN (t{k-1} - 120) / (t{k-1} - t{k}) * {_v[k-1]!r}"
    for k in range(1, 6)) + " ELSE 0 END"
_case_zone = "CASE " + " ".join(
    f"WHEN {' AND '.join(f't{j} >= 120' for j in range(k))} AND t{k} < 120 THEN (120 + t{k-1}) / 2" for k in range(1, 6)) + " END"


def _sums(k: int) -> tuple[str, str]:
    full = range(k - 1)
    v = " + ".join(["0.0", *[repr(_v[i]) for i in full]])
    h = " + ".join(["0.0", *[f"(t{i + 1} + t{i}) / 2 * {_v[i]!r}" for i in full]])
    return v, h


_arms = []
for _k in range(1, 6):
    _sv, _sh = _sums(_k)
    _cond = " AND ".join(f"t{j} >= 120" for j in range(_k)) + f" AND t{_k} < 120"
    _arms.append(f"WHEN {_cond} THEN (({_sh} + v120 * zt) / ({_sv} + v120) - cw) / (120 - cw) * ({_sv} + v120)")
_sv, _sh = _sums(6)
_sv, _sh = f"({_sv} + {_v[5]!r})", f"({_sh} + t5 * {_v[5]!r})"
_equiv = f"CASE WHEN t0 < 120 THEN 0 {' '.join(_arms)} ELSE ({_sh} / {_sv} - cw) / (120 - cw) * {_sv} END"


@query("hot_water_volume", f"""
    WITH t AS ({TANK_SQL}), z AS (SELECT *, {_case_v120} AS v120, {_case_zone} AS zt FROM t)
    SELECT vec_id, round(v120, 6) AS Vol120, round(zt, 6) AS ZoneTemp120, round({_equiv}, 5) AS Vol_Equivalent_to_120 FROM z""")
def hot_water_volume(spark, sf):
    temps = [(120 + 200 * F.col("embedding")[i].cast("double")).alias(n) for i, n in enumerate(hot_water.TANK)]
    df = table(spark, sf, "embeddings").select(
        "vec_id", *temps, (50 + 10 * F.col("embedding")[6].cast("double")).alias("Temp_CityWater_atSkid"))
    out = hot_water.storage_volume(df, LOCATION, 500)
    return out.select("vec_id", rounded("Vol120").alias("Vol120"), rounded("ZoneTemp120").alias("ZoneTemp120"),
                      rounded("Vol_Equivalent_to_120", 5).alias("Vol_Equivalent_to_120"))


@query("power_energy_check", f"""
    WITH h AS (SELECT site, ts, max(CASE WHEN variable = 'click' THEN value END) AS p,
                      max(CASE WHEN variable = 'view' THEN value / 50 END) AS e FROM ({grain_sql()}) GROUP BY 1, 2)
    SELECT site, ts, 'Meter_Power' AS power_variable, 'Meter_Energy' AS energy_variable, round(p, 6) AS power_value,
           round(e * 60, 6) AS expected_power FROM h WHERE p IS NOT NULL AND e IS NOT NULL AND abs(e * 60 - p) > 5""")
def power_energy_check(spark, sf):
    name = F.when(F.col(VARIABLE) == "click", "Meter_Power").when(F.col(VARIABLE) == "view", "Meter_Energy")
    v = F.col(VALUE)
    df = grain_readings(spark, sf).where(F.col(VARIABLE).isin("click", "view")).select(
        SITE, TS, name.alias(VARIABLE), F.when(F.col(VARIABLE) == "view", v / 50).otherwise(v).alias(VALUE))
    return hot_water.power_energy_conflicts(df, margin=5).select(
        SITE, TS, "power_variable", "energy_variable", rounded("power_value").alias("power_value"),
        rounded("expected_power").alias("expected_power"))


PLANT_COLUMNS = {
    "Flow_CityWater": "l_quantity / 10", "Flow_CityWater_atSkid": "l_quantity / 12", "Temp_PrimaryStorageOutTop": "l_extendedprice / 500",
    "Temp_CityWater_atSkid": "50 + l_tax * 100", "Temp_CityWater": "48 + l_discount * 100", "Temp_RecircSupply_MXV1": "l_extendedprice / 600",
    "Temp_RecircSupply_MXV2": "l_extendedprice / 620", "Flow_RecircReturn_MXV1": "l_quantity / 20", "Flow_RecircReturn_MXV2": "l_quantity / 25",
    "Temp_RecircReturn_MXV1": "l_extendedprice / 700", "Temp_RecircReturn_MXV2": "l_extendedprice / 710", "PowerIn_SecLoopPump": "l_tax * 10",
    "EnergyIn_HPWH": "l_quantity / 30",
}
PLANT_SQL = "SELECT l_returnflag AS site, l_shipdate + to_hours(l_linenumber * 3) AS ts, " + ", ".join(
    f"{e} AS {n}" for n, e in PLANT_COLUMNS.items()) + " FROM lineitem"
HEAT_SQL = f"""WITH w AS ({PLANT_SQL}), r AS (SELECT *, (Temp_RecircSupply_MXV1 + Temp_RecircSupply_MXV2) / 2 AS sup,
        strftime(ts, '%H:%M') >= '12:00' AS late FROM w),
    h AS (SELECT site, date_trunc('day', ts) AS ts, avg(sup) AS sup,
        avg(60 * 8.33 * Flow_CityWater_atSkid * (Temp_PrimaryStorageOutTop - Temp_CityWater_atSkid) / 1000) AS plant,
        avg(60 * 8.33 * Flow_CityWater * (sup - Temp_CityWater) / 1000) AS hw,
        avg(60 * 8.33 * Flow_RecircReturn_MXV1 * (Temp_RecircSupply_MXV1 - Temp_RecircReturn_MXV1) / 1000) AS l1,
        avg(60 * 8.33 * Flow_RecircReturn_MXV2 * (Temp_RecircSupply_MXV2 - Temp_RecircReturn_MXV2) / 1000) AS l2,
        avg(PowerIn_SecLoopPump / 60) AS pump, avg(EnergyIn_HPWH) AS hp, avg(Flow_CityWater) AS f, avg(Flow_CityWater_atSkid) AS fs,
        avg(Temp_PrimaryStorageOutTop) AS top, avg(Temp_CityWater_atSkid) FILTER (WHERE late) AS cs, avg(Temp_CityWater) FILTER (WHERE late) AS c
        FROM r GROUP BY 1, 2),
    d AS (SELECT *, 60 * 8.33 * f * (sup - c) / 1000 AS hw_day,
        CASE WHEN top - cs < 2 OR 60 * 8.33 * fs * (top - cs) / 1000 < 0 THEN 0 ELSE 60 * 8.33 * fs * (top - cs) / 1000 END AS plant_day FROM h)"""


def _plant(spark, sf):
    ts = (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3)).alias(TS)
    return _lines(spark, sf).select(F.col("l_returnflag").alias(SITE), ts, *[F.expr(e).alias(n) for n, e in PLANT_COLUMNS.items()])


@query("daily_plant_heat", f"""{HEAT_SQL}
    SELECT site, ts, round(sup, 7) AS Temp_RecircSupply_avg, round(plant, 4) AS HeatOut_PrimaryPlant, round(hw, 4) AS HeatOut_HW,
        round(hw_day, 4) AS HeatOut_HW_dyavg, round(plant_day, 4) AS HeatOut_PrimaryPlant_dyavg FROM d""")
def daily_plant_heat(spark, sf):
    out = hot_water.daily_plant_heat(_plant(spark, sf), "12:00")
    names = ("HeatOut_PrimaryPlant", "HeatOut_HW", "HeatOut_HW_dyavg", "HeatOut_PrimaryPlant_dyavg")
    return out.select(SITE, TS, rounded("Temp_RecircSupply_avg", 7).alias("Temp_RecircSupply_avg"), *[rounded(n, 4).alias(n) for n in names])


@query("daily_plant_cop", f"""{HEAT_SQL}
    SELECT site, ts, round((hw + l1 + l2) / (60 * 3.412) / (hp + pump), 6) AS COP_DHWSys,
        round((hw_day + l1 + l2) / (60 * 3.412) / (hp + pump), 6) AS COP_DHWSys_dyavg,
        round((hw + 27.3) / (60 * 3.412) / (hp + pump), 6) AS COP_DHWSys_fixTMloss,
        round(plant / (60 * 3.412) / (hp + pump), 6) AS COP_PrimaryPlant,
        round(CASE WHEN hp <= 0.01 THEN 0 ELSE plant_day END / (60 * 3.412) / (hp + pump), 6) AS COP_PrimaryPlant_dyavg FROM d""")
def daily_plant_cop(spark, sf):
    out = hot_water.daily_cop(hot_water.daily_plant_heat(_plant(spark, sf), "12:00"), 27.3, sliced=True)
    return out.select(SITE, TS, *[rounded(c).alias(c) for c in out.columns if c.startswith("COP")])


# --- HVAC ------------------------------------------------------------------------------------------

SITE_NAMES = ("AZ2_01", "AZ2_03", "AZ2_04", "MO2_08", "IL2_02")


def _hvac(spark, sf):
    """Line items as wide HVAC rows; five sites by supplier, one event per order."""
    names = F.array(*[F.lit(n) for n in SITE_NAMES])
    return _lines(spark, sf).select(
        F.element_at(names, (F.pmod("l_suppkey", F.lit(5)) + 1).cast("int")).alias(SITE), *KEY,
        F.pmod("l_orderkey", F.lit(400)).alias("event_ID"),
        *[F.expr(e).alias(n) for n, e in HVAC_COLUMNS.items()])


HVAC_COLUMNS = {
    "Power_OD_total1": "CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_tax * (l_orderkey % 4) / 3 END",
    "Power_OD_fan1": "l_discount", "Power_OD_compressor1": "l_tax + 0.5", "Power_AH1": "l_quantity / 20",
    "Power_system1": "l_quantity / 10", "Pressure_staticP": "l_quantity", "Temp_ODT": "l_quantity + 40",
    "Temp_RAT": "70 + l_tax * 100", "Temp_SAT1": "55 + l_quantity / 2", "Temp_SAT2": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 56 + l_quantity / 2 END",
    "Humidity_RARH": "30 + l_quantity", "Pressure_SL_psi": "100 + l_quantity", "Temp_SL_C": "10 + l_quantity / 10", "Temp_LL_C": "20 + l_quantity / 10",
}
HVAC_SQL = ("SELECT CASE l_suppkey % 5 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(SITE_NAMES)) + f" END AS site, {KEY_SQL}, "
            "l_orderkey % 400 AS event_ID, " + ", ".join(f"{e} AS {n}" for n, e in HVAC_COLUMNS.items()) + " FROM lineitem")
SITES = [("AZ2_01", "gas", "txv", 1200.0, 0.05), ("AZ2_03", "electric", "orifice", 500.0, None), ("AZ2_04", "gas", "orifice", None, 0.02),
         ("MO2_08", "electric", "txv", 3300.0, 0.1), ("IL2_02", "gas", "orifice", 5280.0, 0.0)]


def _sites(spark):
    return literal_table(
        spark, [(*r, "410a") for r in SITES],
        "site string, heating_type string, metering_device string, elev double, furn_misc_power double, refrigerant string")


SITES_SQL = "sites(site, heating_type, metering_device, elev, furn) AS (VALUES " + ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in SITES) + ")"


@query("site_power", f"""
    WITH w AS ({HVAC_SQL})
    SELECT site, {KEY_SQL},
      round(CASE WHEN site IN ('AZ2_01', 'MO2_08', 'IL2_02') THEN CASE WHEN Power_OD_total1 - Power_OD_fan1 < 0 THEN 0 ELSE Power_OD_total1 - Power_OD_fan1 END
            ELSE Power_OD_compressor1 END, 6) AS Power_OD_compressor1,
      round(CASE WHEN site = 'AZ2_03' THEN Power_OD_compressor1 + Power_OD_fan1 ELSE Power_OD_total1 END, 6) AS Power_OD_total1,
      round(CASE WHEN site = 'AZ2_03' THEN Power_system1 - (Power_OD_compressor1 + Power_OD_fan1) ELSE Power_AH1 END, 6) AS Power_AH1,
      round(CASE WHEN site = 'AZ2_03' THEN Power_system1 ELSE Power_OD_total1 + Power_AH1 END, 6) AS Power_system1,
      CASE WHEN site = 'MO2_08' THEN Pressure_staticP + 55 ELSE Pressure_staticP END AS Pressure_staticP FROM w""")
def site_power(spark, sf):
    out = hvac.site_power(_hvac(spark, sf))
    names = ("Power_OD_compressor1", "Power_OD_total1", "Power_AH1", "Power_system1")
    return out.select(SITE, *KEY, *[rounded(n).alias(n) for n in names], "Pressure_staticP")


@query("supply_and_line_temperatures", f"""
    WITH w AS ({HVAC_SQL}) SELECT site, {KEY_SQL},
        round((Temp_SAT1 + coalesce(Temp_SAT2, 0)) / (1 + (Temp_SAT2 IS NOT NULL)::INT), 6) AS Temp_SATAvg,
        round(1.8 * Temp_LL_C + 32, 6) AS Temp_LL_F, round(Humidity_RARH + 248.84 * Power_AH1, 6) AS Pressure_staticP FROM w""")
def supply_and_line_temperatures(spark, sf):
    df = _hvac(spark, sf).withColumnsRenamed({"Humidity_RARH": "Pressure_staticPa", "Power_AH1": "Pressure_staticInWC"})
    out = hvac.line_temperatures(hvac.merge_pressure(hvac.mean_supply_temp(df)))
    return out.select(SITE, *KEY, *[rounded(n).alias(n) for n in ("Temp_SATAvg", "Temp_LL_F", "Pressure_staticP")])


STATE_SQL = f"""w AS (SELECT *, (Temp_SAT1 + coalesce(Temp_SAT2, 0)) / (1 + (Temp_SAT2 IS NOT NULL)::INT) AS Temp_SATAvg FROM ({HVAC_SQL})), {SITES_SQL},
    m AS (SELECT site, event_ID, round(avg(Temp_ODT), 9) AS odt, round(avg(Temp_SATAvg) - avg(Temp_RAT), 9) AS dt, avg(Power_OD_total1) AS od
          FROM w WHERE event_ID <> 0 GROUP BY 1, 2),
    g AS (SELECT m.*, heating_type, CASE WHEN dt IS NOT NULL THEN CASE WHEN dt >= 1.5 THEN 'heat' WHEN dt <= -1.5 THEN 'cool' ELSE 'circ' END
          WHEN odt > 65 THEN 'cool' ELSE 'heat' END AS guess FROM m LEFT JOIN sites ON m.site = sites.site),
    st AS (SELECT site, event_ID, CASE WHEN od IS NULL THEN guess
        WHEN heating_type = 'gas' THEN CASE WHEN od >= 0.01 THEN 'cool' WHEN od <= 0.0001 THEN 'circ' ELSE guess END
        WHEN od < 0.01 THEN 'circ' WHEN dt IS NULL THEN CASE WHEN odt > 65 THEN 'cool' ELSE 'heat' END
        WHEN dt >= 1.5 THEN 'heat' ELSE 'cool' END AS HVAC FROM g)"""


@query("hvac_state", f"WITH {STATE_SQL} SELECT w.site, {KEY_SQL}, w.event_ID, HVAC FROM w JOIN st ON w.site = st.site AND w.event_ID = st.event_ID")
def hvac_state(spark, sf):
    df = hvac.mean_supply_temp(_hvac(spark, sf))
    return hvac.event_state(df, _sites(spark)).select(SITE, *KEY, "event_ID", "HVAC")


CFM = [("AZ2_01", "low heat", 900.0, 300.0, "FALSE"), ("AZ2_01", "high heat", 1100.0, 420.0, "FALSE"), ("AZ2_01", "cool", 1000.0, 350.0, "FALSE"),
       ("AZ2_03", "heat", 800.0, 200.0, "TRUE"), ("AZ2_03", "cool", 950.0, 310.0, "TRUE"), ("AZ2_04", "circ", 400.0, 90.0, "FALSE"),
       ("MO2_08", "cool and heat", 700.0, 180.0, "FALSE"), ("IL2_02", "cool", 650.0, 170.0, "TRUE")]


def _cfm(spark):
    return literal_table(spark, CFM, "site string, mode string, ID_blower_cfm double, ID_blower_rms_watts double, use_fan_curve string")


CFM_SQL = "cfm(site, mode, flow, watts, curve) AS (VALUES " + ", ".join(
    "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in CFM) + ")"
FLOW_SQL = f"""{STATE_SQL}, {CFM_SQL}, r AS (SELECT w.*, HVAC FROM w JOIN st ON w.site = st.site AND w.event_ID = st.event_ID),
    heats AS (SELECT site, bool_or(HVAC = 'heat') AS heats FROM r GROUP BY 1),
    f AS (SELECT r.*, s.elev, CASE WHEN (SELECT bool_or(curve = 'TRUE') FROM cfm c WHERE c.site = r.site)
            THEN CASE WHEN Power_AH1 - CASE WHEN heats THEN coalesce(furn, 0) ELSE 0 END >= 0
                THEN cbrt(1000 * (Power_AH1 - CASE WHEN heats THEN coalesce(furn, 0) ELSE 0 END)) END
            ELSE coalesce((SELECT avg(flow) FROM cfm c WHERE c.site = r.site AND contains(c.mode, r.HVAC)), 0) END AS Cfm_Calc
          FROM r JOIN heats ON r.site = heats.site JOIN sites s ON r.site = s.site)"""


def _flow(spark, sf):
    state = hvac.event_state(hvac.mean_supply_temp(_hvac(spark, sf)), _sites(spark))
    return hvac.airflow(state, _cfm(spark), _sites(spark))


@query("airflow", f"WITH {FLOW_SQL} SELECT site, {KEY_SQL}, HVAC, round(Cfm_Calc, 5) AS Cfm_Calc FROM f")
def airflow(spark, sf):
    return _flow(spark, sf).select(SITE, *KEY, "HVAC", rounded("Cfm_Calc", 5).alias("Cfm_Calc"))


ACF = "acf(x, y) AS (VALUES " + ", ".join(f"({x}, {y})" for x, y in curves.ALTITUDE_CORRECTION) + ")"


@query("hvac_cop", f"""
    WITH {FLOW_SQL}, {ACF}, fit AS (SELECT regr_slope(y, x) AS m, regr_intercept(y, x) AS b FROM acf)
    SELECT site, {KEY_SQL}, round(coalesce(CASE WHEN Power_system1 = 0 THEN 0 ELSE abs(CASE WHEN HVAC IN ('heat', 'circ') THEN 0 ELSE
        (Temp_SAT1 - Temp_RAT) * Cfm_Calc * 1.08 * CASE WHEN elev >= 1000 THEN m * elev + b ELSE 1 END END / 3.412 / 1000 / Power_system1) END, 0), 6) AS cop
    FROM f, fit""")
def hvac_cop(spark, sf):
    return hvac.hvac_cop(_flow(spark, sf), _sites(spark)).select(SITE, *KEY, rounded("cop").alias("cop"))


@query("altitude_correction", f"""
    WITH {ACF} SELECT c_custkey, round(CASE WHEN c_acctbal >= 1000 THEN
        (SELECT regr_slope(y, x) FROM acf) * c_acctbal + (SELECT regr_intercept(y, x) FROM acf) ELSE 1 END, 6) AS air_corr FROM customer""")
def altitude_correction(spark, sf):
    sites = table(spark, sf, "customer").select(F.col("c_custkey").alias(SITE), F.col("c_acctbal").alias("elev"))
    return hvac.air_correction(sites).select(F.col(SITE).alias("c_custkey"), rounded("air_corr").alias("air_corr"))


@query("fit_curve", """
    SELECT p_brand, round(regr_slope(p_retailprice, p_size), 6) AS slope, round(regr_intercept(p_retailprice, p_size), 5) AS intercept
    FROM part GROUP BY 1""")
def fit_curve(spark, sf):
    fit = curves.fit_line(table(spark, sf, "part"), "p_retailprice", "p_size", ["p_brand"])
    return fit.select("p_brand", rounded("slope").alias("slope"), rounded("intercept", 5).alias("intercept"))


@query("fan_curves", """
    WITH r AS (SELECT p_brand AS site, p_retailprice AS cfm,
        pow(p_size * 10 + 50 - CASE WHEN p_type LIKE '%A%' THEN 20 ELSE 0 END, 0.3333) - 1 AS x FROM part)
    SELECT site, round(regr_intercept(cfm, x), 4) AS a, round(regr_slope(cfm, x), 4) AS b FROM r GROUP BY 1""")
def fan_curves(spark, sf):
    parts = table(spark, sf, "part")
    cfm = parts.select(F.col("p_brand").alias(SITE), F.col("p_retailprice").alias("ID_blower_cfm"),
                       (F.col("p_size") * 10 + 50).alias("ID_blower_rms_watts"),
                       F.when(F.col("p_type").contains("A"), "heat").otherwise("cool").alias("mode"))
    sites = parts.select(F.col("p_brand").alias(SITE)).distinct().withColumn("furn_misc_power", F.lit(0.02))
    out = hvac.fan_curves(cfm, sites)
    return out.select(SITE, rounded("a", 4).alias("a"), rounded("b", 4).alias("b"))


KNOTS = [("click", 0.0, 10.0), ("click", 25.0, 30.0), ("click", 60.0, 35.0), ("click", 200.0, 90.0),
         ("view", 5.0, 100.0), ("view", 80.0, 40.0), ("view", 300.0, 0.0)]
SEGMENTS = "seg AS (SELECT * FROM (SELECT curve, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM (VALUES " + ", ".join(
    f"('{c}', {x}, {y})" for c, x, y in KNOTS) + ") k(curve, x, y) WINDOW w AS (PARTITION BY curve ORDER BY x)) WHERE x1 IS NOT NULL)"


@query("interpolate_curve", f"""
    WITH {SEGMENTS} SELECT e.event_id, round(y0 + (y1 - y0) * ((e.value - x0) / (x1 - x0)), 6) AS value FROM events e
    LEFT JOIN seg ON e.event_type = curve AND e.value >= x0 AND (e.value < x1 OR (e.value = x1 AND x1 IN (200, 300)))""")
def interpolate_curve(spark, sf):
    knots = literal_table(spark, KNOTS, "curve string, x double, y double")
    df = table(spark, sf, "events").select("event_id", F.col("event_type").alias("curve"), VALUE)
    out = curves.apply_curve(df, VALUE, curves.curve_segments(knots), VALUE, 25)
    return out.select("event_id", rounded(VALUE).alias(VALUE))


BACK = [("all", 0.0, 5.0), ("all", 40.0, 25.0), ("all", 100.0, 145.0)]


@query("calibration", """
    WITH f AS (SELECT event_id, CASE WHEN value <= 100 THEN value * 0.8 ELSE 80 + (value - 100) * 0.1 END AS mid FROM events WHERE value <= 300)
    SELECT e.event_id, round(CASE WHEN mid <= 40 THEN 5 + mid * 0.5 ELSE 25 + (mid - 40) * 2 END, 6) AS value
    FROM events e LEFT JOIN f ON e.event_id = f.event_id""")
def calibration(spark, sf):
    """A reading passed through two curves; outside the first curve there is no value."""
    names = "curve string, x double, y double"
    forward = curves.curve_segments(literal_table(spark, [("all", 0.0, 0.0), ("all", 100.0, 80.0), ("all", 300.0, 100.0)], names))
    backward = curves.curve_segments(literal_table(spark, BACK, names))
    df = table(spark, sf, "events").select("event_id", F.lit("all").alias("curve"), VALUE)
    out = curves.apply_calibration(df, VALUE, forward, backward, 50, 20)
    return out.select("event_id", rounded(VALUE).alias(VALUE))


PT = [(100.0, 32.0), (118.0, 40.0), (142.0, 50.0), (170.0, 60.0), (201.0, 70.0)]
CHART = [(odt, wb, 40.0 - odt / 5 + wb / 2) for odt in range(40, 95, 5) for wb in range(50, 78, 2)]


@query("refrigerant_charge", f"""
    WITH w AS ({HVAC_SQL}), {SITES_SQL},
    pt(p, t) AS (VALUES {", ".join(f"({p}, {t})" for p, t in PT)}), fit AS (SELECT regr_slope(t, p) AS m, regr_intercept(t, p) AS b FROM pt),
    r AS (SELECT w.*, metering_device, m * Pressure_SL_psi + b AS sat, (Temp_RAT - 32) * 5 / 9 AS c, Humidity_RARH AS h FROM w JOIN sites ON w.site = sites.site, fit),
    wet AS (SELECT *, (c * atan(0.151977 * sqrt(h + 8.31659)) + atan(c + h) - atan(h - 1.676331)
        + 0.00391838 * pow(h, 1.5) * atan(0.023101 * h) - 4.686035) * 9 / 5 + 32 AS wb FROM r)
    SELECT site, {KEY_SQL}, round(CASE metering_device WHEN 'txv' THEN sat - (Temp_LL_C * 9 / 5 + 32)
        ELSE CASE WHEN Temp_ODT BETWEEN 40 AND 90 AND wb BETWEEN 50 AND 76 THEN Temp_SL_C * 9 / 5 + 32 - sat - (40 - Temp_ODT / 5 + wb / 2) END END, 6) AS Refrig_charge
    FROM wet""")
def refrigerant_charge(spark, sf):
    """The chart is a plane, so bilinear interpolation must give the plane's own value."""
    pt = literal_table(spark, [(*r, "410a") for r in PT], "pressure double, temp double, refrigerant string")
    chart = literal_table(spark, CHART, "odt double, wb double, target double")
    out = hvac.refrigerant_charge(_hvac(spark, sf), _sites(spark), pt, chart)
    return out.select(SITE, *KEY, rounded("Refrig_charge").alias("Refrig_charge"))


HOURLY = f"SELECT site, ts, value FROM ({grain_sql()}) WHERE variable = 'click'"


@query("condensate_energy", f"""
    SELECT site, ts, round((lead(value) OVER (PARTITION BY site ORDER BY ts) - value) / 6 * 1.5 * (1.0 / 33810) * 997 * 2264.705 / 1000, 8) AS Condensate_kJ
    FROM ({HOURLY})""")
def condensate_energy(spark, sf):
    df = grain_readings(spark, sf).where(F.col(VARIABLE) == "click").select(SITE, TS, F.col(VALUE).alias("Condensate_ontime"))
    sites = df.select(SITE).distinct().withColumns({"condensate_cycle_length": F.lit(6.0), "condensate_oz_per_tip": F.lit(1.5)})
    return hvac.condensate(df, sites).select(SITE, TS, F.round("Condensate_kJ", 8).alias("Condensate_kJ"))


@query("gas_valve_difference", f"""
    SELECT site, ts, round(CASE WHEN site IN ('site_0', 'site_2', 'site_4', 'site_6', 'site_8')
        THEN value - lag(value) OVER (PARTITION BY site ORDER BY ts) ELSE value END, 6) AS gasvalve FROM ({HOURLY})""")
def gas_valve_difference(spark, sf):
    df = grain_readings(spark, sf).where(F.col(VARIABLE) == "click").select(SITE, TS, F.col(VALUE).alias("gasvalve"))
    even = F.substring(SITE, 6, 1).cast("int") % 2 == 0
    sites = df.select(SITE).distinct().withColumn("heating_type", F.when(even, "gas").otherwise("electric"))
    return hvac.gas_valve_difference(df, sites).select(SITE, TS, rounded("gasvalve").alias("gasvalve"))

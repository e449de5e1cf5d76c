"""Fixed values of the alarm detectors: tags, defaults, mode names and message formats."""

import string

from pyspark.sql import Column, functions as F

BOUNDARY = "BOUNDRY"
TEMP_RANGE = "TMPRANG"
BLOWN_FUSE = "BLWNFSE"
INLET = "HPINLET"
OUTLET = "HPOUTLT"
TM_SETPOINT = "TMNSTPT"
BACKUP = "IMBCKUP"
BALANCING = "BALVALV"
ABNORMAL_COP = "ABNRMCP"
POWER_RATIO = "POWRRAT"
OUTAGE = "HPOUTGE"
SOO_CHANGE = "SOOCHNG"
SHORT_CYCLE = "SHRTCYC"
SOO_SCHEDULE = "SOOSCHD"

HIGH, MEDIUM, LOW = 3, 2, 1

MODES = {
    "loadUp": "LOAD UP",
    "shed": "SHED",
    "criticalPeak": "CRITICAL PEAK",
    "gridEmergency": "GRID EMERGENCY",
    "advLoadUp": "ADVANCED LOAD UP",
}

ELEMENT_SUFFIXES = "(_Inlet|_inlet|_Outlet|_outlet|Inlet|inlet|Outlet|outlet)$"

# {name} is a column; {name:.1f} a column with that many decimals.
MESSAGES = {
    BOUNDARY: "Boundary alarm for {pretty}",
    TEMP_RANGE: "Temperature out of range: {pretty} was outside {low}-{high} F for {length} consecutive minutes starting at {start}.",
    BLOWN_FUSE: "Blown Fuse: {variable} had a power draw less than {high:.1f} while element was ON starting at {start}.",
    TM_SETPOINT: "Setpoint altered: {pretty} was {actual} for {length} minutes starting at {start} (expected {low}).",
    BACKUP: "Swing tank setpoint was altered: {pretty} was {actual} for {length} minutes starting at {start} (expected {low}).",
    OUTAGE: "Heat pump alarm triggered: {pretty} was {actual} for {length} minutes starting at {start}.",
    INLET: "High heat pump inlet temperature: {pretty} was above {bound:.1f} F for {length} minutes while HP was ON starting at {start}.",
    OUTLET: "Low heat pump outlet temperature: {pretty} was {actual:.1f} F (below {bound:.1f} F) for {length} minutes while HP was ON starting at {start}.",
    "TMNSTPT draw": "High TM Setpoint: {power_pretty} showed draw for {length} minutes starting at {start} while {pretty} was {actual:.1f} F (above {bound} F).",
    "TMNSTPT share": "High temperature maintenance power ratio: TM heating accounted for {percent:.1f}% of daily power (threshold {limit}%).",
    "IMBCKUP share": "Improper Back Up Use: Sum of back up equipment ({power:.2f}) exceeds {limit:.2f}% of total power.",
    "BALVALV share": "Recirculation imbalance: Sum of recirculation equipment ({power:.2f}) exceeds or equals {limit:.2f}% of total power.",
    "BALVALV heat": "Recirculation imbalance: Sum of recirculation equipment power ({power:.2f} kW) exceeds TM heating output ({heat:.2f} kW).",
    ABNORMAL_COP: "Unexpected COP Value detected: {pretty} = {actual}",
    POWER_RATIO: "Power ratio alarm ({days}-day block ending {ending}): {pretty} accounted for {percent:.1f}% of {group} energy use. {low:.1f}-{high:.1f}% expected.",
    "HPOUTGE share": "Possible Heat Pump failure or outage.",
    "SOOCHNG on": "Unexpected SOO change: during {mode}, HP turned on at {start} but {pretty} was {actual:.1f} F (setpoint at {bound} F).",
    "SOOCHNG off": "Unexpected SOO change: during {mode}, HP turned off at {start} but {pretty} was {actual:.1f} F (setpoint at {bound} F).",
    SHORT_CYCLE: "Short cycle: {pretty} was on for only {length} minutes starting at {start}.",
    "SOOSCHD normal": "Load shift mode inconsistency: {pretty} was {actual} for {length} minutes starting at {start} during normal operation (expected {low}).",
    "SOOSCHD mode": "Load shift mode inconsistency: {pretty} was {actual} for {length} minutes starting at {start} during {mode} event (expected {low}).",
}


def _number(name: str) -> str:
    """A double as the messages show it: missing is ``nan``, infinity ``inf``."""
    return (f"CASE WHEN {name} IS NULL THEN 'nan' WHEN {name} = double('Infinity') THEN 'inf' "
            f"WHEN {name} = double('-Infinity') THEN '-inf' ELSE string({name}) END")


def message_sql(name: str, doubles: tuple[str, ...] = ()) -> str:
    """The message as a SQL expression; ``doubles`` are shown as numbers, times as text."""
    parts = []
    for literal, field, spec, _ in string.Formatter().parse(MESSAGES[name]):
        if literal:
            parts.append("'" + literal.replace("'", "\\'") + "'")
        if field is None:
            continue
        if spec:
            # what a sum leaves behind the 12th decimal does not turn a tie
            parts.append(f"CASE WHEN {field} IS NULL THEN 'nan' ELSE format_string('%{spec}', round({field}, 12)) END")
        elif field in doubles:
            parts.append(_number(field))
        elif field == "start":
            parts.append("date_format(start, 'yyyy-MM-dd HH:mm:ss')")
        else:
            parts.append(f"string({field})")
    return f"concat({', '.join(parts)})"


def message(name: str, doubles: tuple[str, ...] = ()) -> Column:
    return F.expr(message_sql(name, doubles))

"""Row formulas of the water-heating and HVAC metrics."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wattloom.functions.units import BTUH_PER_KW, fahrenheit_to_celsius
from wattloom.model import ratio

# Magnus coefficients and the efficiency derate by insulation R-value
# (upper limit of the step, factor).
MAGNUS_BASE, MAGNUS_B, MAGNUS_C = 6.11, 7.5, 237.3
DERATE_STEPS = ((16, 0.88), (20, 0.90), (24, 0.92), (28, 0.94), (32, 0.96))
DERATE_TOP = 0.98
DERATE_MINIMUM = 12


def three_phase_power(a: Column, b: Column, c: Column, volts: float = 208, power_factor: float = 1) -> Column:
    """kW from three phase currents at an assumed line voltage."""
    return (a + b + c) / 3 * volts * power_factor * math.sqrt(3) / 1000


def heat_output(flow: Column, hot: Column, cold: Column, as_kw: bool = True) -> Column:
    btuh = 500 * flow * (hot - cold)
    positive = F.when(btuh > 0, btuh).otherwise(F.lit(0.0))
    return positive / BTUH_PER_KW if as_kw else positive


def relative_humidity(temp: Column, dew_point: Column, fahrenheit: bool = True) -> Column:
    """Percent, clipped to 0..100; missing when either input is missing."""
    if fahrenheit:
        temp, dew_point = fahrenheit_to_celsius(temp), fahrenheit_to_celsius(dew_point)

    def vapour_pressure(t: Column) -> Column:
        return MAGNUS_BASE * F.pow(F.lit(10.0), ratio(MAGNUS_B * t, t + MAGNUS_C))

    percent = ratio(vapour_pressure(dew_point), vapour_pressure(temp)) * 100.0
    return F.when(percent < 0, 0.0).when(percent > 100, 100.0).otherwise(percent)


def cop_boundary(heat_out: Column, loop_loss: Column | float, power: Column) -> Column:
    """System COP from primary heat output plus recirculation loss."""
    loss = F.lit(loop_loss) if isinstance(loop_loss, (int, float)) else loop_loss
    return ratio(heat_out + loss, power)


def cop_weighted(columns: Sequence[str], cop_primary: Column, cop_tm: Column | float) -> Column:
    """Power-weighted mix of primary and temperature-maintenance COP, by column-name prefix.

    Missing when any contributing power is missing.
    """
    primary = [c for c in columns if c.startswith("PowerIn_HPWH") or c == "PowerIn_SecLoopPump"]
    upkeep = [c for c in columns if c.startswith(("PowerIn_SwingTank", "PowerIn_ERTank"))]
    if not primary or not upkeep or "PowerIn_Total" not in columns:
        raise ValueError("needs PowerIn_Total, a primary and a temperature-maintenance power column")
    total = F.col("PowerIn_Total")
    tm = F.lit(cop_tm) if isinstance(cop_tm, (int, float)) else cop_tm
    add = lambda names: sum((F.col(n) for n in names), F.lit(0.0))
    return cop_primary * ratio(add(primary), total) + tm * ratio(add(upkeep), total)


def cop_derate(r_value: Column | float) -> Column:
    """Derate factor for an equipment COP; raises for an R-value under the minimum."""
    r = F.lit(r_value) if isinstance(r_value, (int, float)) else r_value
    if isinstance(r_value, (int, float)) and r_value < DERATE_MINIMUM:
        raise ValueError(f"R value must be at least {DERATE_MINIMUM}")
    ladder = F.when(r < DERATE_MINIMUM, F.raise_error(F.lit("R value must be at least 12")).cast("double"))
    for limit, factor in DERATE_STEPS:
        ladder = ladder.when(r < limit, F.lit(factor))
    return ladder.otherwise(F.lit(DERATE_TOP))


def wet_bulb_fahrenheit(temp_f: Column, humidity: Column) -> Column:
    """Stull's approximation of the wet-bulb temperature."""
    t = fahrenheit_to_celsius(temp_f)
    celsius = (
        t * F.atan(0.151977 * F.sqrt(humidity + 8.31659))
        + F.atan(t + humidity)
        - F.atan(humidity - 1.676331)
        + 0.00391838 * F.pow(humidity, F.lit(1.5)) * F.atan(0.023101 * humidity)
        - 4.686035
    )
    return celsius * 9 / 5 + 32

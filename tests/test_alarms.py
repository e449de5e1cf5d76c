"""Detectors on small literal frames: fired, not fired, missing values, malformed codes."""

from datetime import datetime, timedelta

import pytest

from wattloom.model import SCHEDULE, to_long
from wattloom.operators import alarms
from wattloom.operators.alarms import text

DAY = datetime(2022, 1, 1)
RULES = ("variable_name string, alarm_codes string, pretty_name string, low_alarm string, high_alarm string, fault_time string, "
         "system string")


def rules(spark, *entries):
    return spark.createDataFrame([tuple(e) + (None,) * (7 - len(e)) for e in entries], RULES)


def wide(spark, start=DAY, step=1, **columns):
    """A wide frame of one site as long readings, one row per ``step`` minutes."""
    names = list(columns)
    n = len(columns[names[0]])
    data = [("a", start + timedelta(minutes=i * step), *[None if columns[c][i] is None else float(columns[c][i]) for c in names])
            for i in range(n)]
    df = spark.createDataFrame(data, "site string, ts timestamp_ntz, " + ", ".join(f"{c} double" for c in names))
    return to_long(df, names)


def days(spark, **columns):
    return wide(spark, step=1440, **columns)


def found(df):
    return sorted((r.start_time_pt, r.end_time_pt, r.alarm_type, r.variable_name, r.certainty, r.event_detail) for r in df.collect())


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def test_boundary_bounds_runs_and_text_in_bounds(spark):
    df = wide(spark, v1=[5, 1, 1, 1, 5, 1, 5], v2=[9, 9, None, 9, 9, 9, float("inf")], v3=[1] * 7)
    book = rules(spark, ("v1", None, "One", "2", "text", "3"), ("v2", None, None, None, "8", "3"), ("v3", None, None, "text", None, "1"),
                 ("gone", None, None, "1", "2", "1"))
    got = found(alarms.flag_boundary(df, None, book))
    assert got == [(at(1), at(4), "BOUNDRY", "v1", 3, "Boundary alarm for One"),
                   (at(3), at(7), "BOUNDRY", "v2", 3, "Boundary alarm for v2")]


def test_boundary_does_not_cross_midnight(spark):
    df = wide(spark, start=DAY + timedelta(minutes=1438), v1=[1, 1, 1, 1])
    assert found(alarms.flag_boundary(df, None, rules(spark, ("v1", None, None, "2", None, "3")))) == []


def test_boundary_default_rows(spark):
    df = wide(spark, v1=[1] * 15)
    got = found(alarms.flag_boundary(df, None, rules(spark, ("v1", None, None, "2", None, None))))
    assert [(g[0], g[1]) for g in got] == [(at(0), at(15))]


def test_temp_range_defaults_and_message(spark):
    df = wide(spark, Temp_DHW=[140] * 12 + [120] + [100] * 9)
    day = days(spark, Temp_DHW=[120])
    got = found(alarms.flag_temp_range(df, day, rules(spark, ("Temp_DHW", "TMPRANG", "Supply"))))
    assert got == [(at(0), at(12), "TMPRANG", "Temp_DHW", 3,
                    "Temperature out of range: Supply was outside 115.0-130.0 F for 12 consecutive minutes starting at 2022-01-01 00:00:00.")]


def test_temp_range_needs_a_daily_row(spark):
    df = wide(spark, Temp_DHW=[140] * 12)
    later = wide(spark, start=DAY + timedelta(days=3), Temp_DHW=[1])
    assert found(alarms.flag_temp_range(df, later, rules(spark, ("Temp_DHW", "TMPRANG")))) == []


@pytest.mark.parametrize("code", ["TMPRANG:1:2", "TMPRANG:110", "TMPRANG:1-2-3"])
def test_malformed_range_codes_fail(spark, code):
    df, day = wide(spark, Temp_DHW=[140] * 12), days(spark, Temp_DHW=[120])
    with pytest.raises(Exception, match="more than one colon|written low-high"):
        alarms.flag_temp_range(df, day, rules(spark, ("Temp_DHW", code))).collect()


def test_name_without_a_unit_fails(spark):
    df, day = wide(spark, Temp=[140] * 12), days(spark, Temp=[120])
    with pytest.raises(Exception, match="Improper variable name"):
        alarms.flag_temp_range(df, day, rules(spark, ("Temp", "TMPRANG"))).collect()


def test_two_codes_for_one_variable_fail(spark):
    df, day = wide(spark, PowerIn_ER1=[10] * 4), days(spark, PowerIn_ER1=[10])
    with pytest.raises(Exception, match="several codes"):
        alarms.flag_blown_fuse(df, day, rules(spark, ("PowerIn_ER1", "BLWNFSE:20;BLWNFSE:30"))).collect()


def test_blown_fuse(spark):
    df = wide(spark, PowerIn_ER1=[20, 20, 20, 0.5, 28, 20, 20, None])
    day = days(spark, PowerIn_ER1=[10])
    got = found(alarms.flag_blown_fuse(df, day, rules(spark, ("PowerIn_ER1", "BLWNFSE"))))
    assert [(g[0], g[1]) for g in got] == [(at(0), at(3))]
    assert got[0][5].startswith("Blown Fuse: PowerIn_ER1 had a power draw less than 28.0 while")


def test_inlet_pairs_by_element_and_ignores_missing(spark):
    df = wide(spark, PowerIn_HPWH1=[2] * 6 + [0], Temp_HPWH1_Inlet=[120, 120, 120, 120, 120, 120, 120],
              PowerIn_HPWH2=[2] * 7, Temp_HPWH2Inlet=[120, 120, None, 120, 120, 120, 120])
    day = days(spark, PowerIn_HPWH1=[1])
    book = rules(spark, *[(n, "HPINLET") for n in ("PowerIn_HPWH1", "Temp_HPWH1_Inlet", "PowerIn_HPWH2", "Temp_HPWH2Inlet")])
    got = found(alarms.flag_inlet_temp(df, day, book))
    assert got == [(at(0), at(6), "HPINLET", "Temp_HPWH1_Inlet", 3,
                    "High heat pump inlet temperature: Temp_HPWH1_Inlet was above 115.0 F for 6 minutes while HP was ON starting at 2022-01-01 00:00:00.")]


def test_inlet_needs_both_members(spark):
    df, day = wide(spark, PowerIn_HPWH1=[2] * 6), days(spark, PowerIn_HPWH1=[1])
    with pytest.raises(Exception, match="needs a power and a temperature|Improper alarm codes"):
        alarms.flag_inlet_temp(df, day, rules(spark, ("PowerIn_HPWH1", "HPINLET"))).collect()


def test_outlet_skips_the_warm_up(spark):
    df = wide(spark, PowerIn_HPWH=[0] + [2] * 16 + [0] * 4, Temp_HPWH_Outlet=[100] * 21)
    day = days(spark, PowerIn_HPWH=[1])
    got = found(alarms.flag_outlet_temp(df, day, rules(spark, ("PowerIn_HPWH", "HPOUTLT"), ("Temp_HPWH_Outlet", "HPOUTLT"))))
    assert [(g[0], g[1]) for g in got] == [(at(11), at(17))]
    assert "was 100.0 F (below 140.0 F) for 6 minutes" in got[0][5]


def test_tm_setpoint_three_parts(spark):
    df = wide(spark, Setpoint_Swing=[130] * 2 + [None] * 3 + [131] * 8, Temp_Swing=[140] * 13, PowerIn_Swing=[2] * 3 + [0] * 10)
    day = days(spark, PowerIn_Swing=[5.0], PowerIn_Total=[10.0], Temp_Swing=[1])
    book = rules(spark, ("Setpoint_Swing", "TMNSTPT"), ("Temp_Swing", "TMNSTPT"), ("PowerIn_Swing", "TMNSTPT"), ("PowerIn_Total", "TMNSTPT"))
    got = found(alarms.flag_tm_setpoint(df, day, book))
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [
        (at(0), at(3), "PowerIn_Swing", 2), (at(0), at(1440), "PowerIn_Total", 1), (at(2), at(13), "Setpoint_Swing", 3)]
    assert got[1][5].endswith("TM heating accounted for 50.0% of daily power (threshold 40.0%).")
    assert "was 131.0 for 11 minutes" in got[2][5]  # missing setpoints count as altered


def test_backup_use_sums_and_adds_a_minute(spark):
    df = wide(spark, PowerIn_B1=[0])
    day = days(spark, PowerIn_B1=[0.6, 0.1], PowerIn_B2=[0.4, None], PowerIn_Total=[10.0, 10.0])
    book = rules(spark, ("PowerIn_B1", "IMBCKUP"), ("PowerIn_B2", "IMBCKUP"), ("PowerIn_Total", "IMBCKUP"))
    got = found(alarms.flag_backup_use(df, day, book))
    assert [(g[0], g[1], g[4]) for g in got] == [(at(0), at(1441), 2)]
    assert "(1.00) exceeds 10.00% of total power" in got[0][5]


def test_balancing_valve_heat_only_when_share_is_quiet(spark):
    day = days(spark, PowerIn_ER=[5.0, 2.0], HeatOut_TM=[4.0, 1.0], PowerIn_Total=[10.0, 10.0])
    book = rules(spark, ("PowerIn_ER", "BALVALV"), ("HeatOut_TM", "BALVALV"), ("PowerIn_Total", "BALVALV"))
    assert [g[3] for g in found(alarms.flag_balancing_valve(None, day, book))] == ["PowerIn_Total"]
    quiet = days(spark, PowerIn_ER=[3.0, 2.0], HeatOut_TM=[4.0, 1.0], PowerIn_Total=[10.0, 10.0])
    got = found(alarms.flag_balancing_valve(None, quiet, book))
    assert [(g[0], g[3], g[4]) for g in got] == [(at(1440), "HeatOut_TM", 1)]
    without_total = rules(spark, ("PowerIn_ER", "BALVALV"), ("HeatOut_TM", "BALVALV"))
    assert len(found(alarms.flag_balancing_valve(None, day, without_total))) == 1  # both days touch and merge
    with pytest.raises(Exception, match="needs a power and a temperature|Improper alarm codes"):
        alarms.flag_balancing_valve(None, day, rules(spark, ("HeatOut_TM", "BALVALV"))).collect()


def test_abnormal_cop_with_infinity_and_null(spark):
    day = days(spark, COP_Equipment=[2.0, float("inf"), None, 0.5], SystemCOP=[float("-inf"), 3.0, 3.0, 3.0])
    book = rules(spark, ("COP_Equipment", "ABNRMCP:1.0-5.5", "Equipment"), ("SystemCOP", "ABNRMCP"))
    got = found(alarms.flag_abnormal_cop(None, day, book))
    assert [(g[0], g[3], g[5]) for g in got] == [
        (at(0), "SystemCOP", "Unexpected COP Value detected: SystemCOP = -inf"),
        (at(1440), "COP_Equipment", "Unexpected COP Value detected: Equipment = inf"),
        (at(4320), "COP_Equipment", "Unexpected COP Value detected: Equipment = 0.5")]


def test_power_ratio_groups(spark):
    day = days(spark, PowerIn_HPWH1=[50.0, 300.0], PowerIn_HPWH2=[50.0, float("inf")], PowerIn_Total=[100.0, 600.0], PowerIn_SwingTank=[40.0, 10.0])
    book = rules(spark, ("PowerIn_HPWH1", "POWRRAT:60-70", "One"), ("PowerIn_HPWH2", "POWRRAT:40-60"), ("PowerIn_Total", "POWRRAT:60-80"),
                 ("PowerIn_SwingTank", "POWRRAT:5-30"))
    got = found(alarms.flag_power_ratio(None, day, book, days=1))
    assert [(g[0], g[3]) for g in got] == [(at(0), "PowerIn_HPWH1"), (at(0), "PowerIn_SwingTank")]
    assert got[0][5] == ("Power ratio alarm (1-day block ending 2022-01-01): One accounted for 50.0% of HPWH energy use. "
                         "60.0-70.0% expected.")


def test_power_ratio_uses_stored_days(spark):
    day = wide(spark, start=DAY + timedelta(days=2), PowerIn_Total=[100.0], PowerIn_SwingTank=[90.0])
    old = days(spark, PowerIn_Total=[100.0, 100.0], PowerIn_SwingTank=[1.0, 1.0])
    book = rules(spark, ("PowerIn_Total", "POWRRAT"), ("PowerIn_SwingTank", "POWRRAT:0-50"))
    assert found(alarms.flag_power_ratio(None, day, book, days=3)) == []
    assert found(alarms.flag_power_ratio(None, day, book, days=3, stored=old)) == []
    assert len(found(alarms.flag_power_ratio(None, day, book, days=1))) == 1
    with pytest.raises(ValueError):
        alarms.flag_power_ratio(None, day, book, days=0)
    with pytest.raises(Exception, match="is not a power variable"):
        alarms.flag_power_ratio(None, day, rules(spark, ("Temp_X", "POWRRAT:1-2")), days=1).collect()


def test_outage_flag_wins_over_share(spark):
    df = wide(spark, Alarm_HPWH=[0, 1, 1, 0, None, 0])
    day = days(spark, PowerIn_HPWH=[1.0] * 7, PowerIn_Total=[10.0] * 7)
    book = rules(spark, ("Alarm_HPWH", "HPOUTGE", "Flag"), ("PowerIn_HPWH", "HPOUTGE"), ("PowerIn_Total", "HPOUTGE"))
    got = found(alarms.flag_outage(df, day, book))
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [(at(1), at(5), "Alarm_HPWH", 3)]  # one minute apart, so merged
    assert got[0][5] == "Heat pump alarm triggered: Flag was 1.0 for 2 minutes starting at 2022-01-01 00:01:00."
    quiet = wide(spark, Alarm_HPWH=[0] * 6)
    got = found(alarms.flag_outage(quiet, day, book))
    assert [(g[0], g[3], g[4]) for g in got] == [(at(6 * 1440), "PowerIn_HPWH", 2)]
    with pytest.raises(ValueError):
        alarms.flag_outage(quiet, day, book, days=1)


def windows(spark, *rows):
    return spark.createDataFrame([("a", e, s, t, i) for i, (e, s, t) in enumerate(rows)], SCHEDULE)


def test_soo_change_per_mode(spark):
    df = wide(spark, PowerIn_HP=[0, 2, 2, 0, 2, 0, 0, 2], Temp_On=[100, 100, 100, 100, 116, 100, 100, 100], Temp_Off=[140] * 5 + [120] * 3)
    day = days(spark, PowerIn_HP=[1])
    book = rules(spark, ("PowerIn_HP", "SOOCHNG"), ("Temp_On", "SOOCHNG_ON;SOOCHNG_ON_shed:98"), ("Temp_Off", "SOOCHNG_OFF;SOOCHNG_OFF_shed"))
    none = windows(spark)
    got = found(alarms.flag_soo_change(df, day, book, none))
    assert [(g[0], g[3], g[4]) for g in got] == [(at(1), "Temp_On", 2), (at(5), "Temp_Off", 2), (at(7), "Temp_On", 2)]
    assert got[0][5].endswith("during NORMAL, HP turned on at 2022-01-01 00:01:00 but Temp_On was 100.0 F (setpoint at 115.0 F).")
    shed = windows(spark, ("shed", at(0), at(3)))
    assert [g[0] for g in found(alarms.flag_soo_change(df, day, book, shed))] == [at(5), at(7)]
    with pytest.raises(Exception, match="an ON and an OFF"):
        alarms.flag_soo_change(df, day, rules(spark, ("PowerIn_HP", "SOOCHNG"), ("Temp_On", "SOOCHNG_ON")), none).collect()


def test_short_cycle(spark):
    df = wide(spark, PowerIn_HP=[2, 0, 2, 2, 0, 0, None, 2, 2])
    got = found(alarms.flag_short_cycle(df, None, rules(spark, ("PowerIn_HP", "SHRTCYC", "Pump"))))
    assert got == [(at(2), at(4), "SHRTCYC", "PowerIn_HP", 3,
                    "Short cycle: Pump was on for only 2 minutes starting at 2022-01-01 00:02:00.")]


def test_schedule_mismatch_modes_and_normal(spark):
    df = wide(spark, soo_mode=[1, 1, 1, 2, 2, 1, None, 1, 1])
    day = days(spark, soo_mode=[1])
    book = rules(spark, ("soo_mode", "SOOSCHD_normal:1;SOOSCHD_loadUp:2;SOOSCHD_other:3"))
    plan = windows(spark, ("loadUp", at(2), at(5)), ("shed", at(8), at(9)))
    got = found(alarms.flag_schedule_mismatch(df, day, book, plan))
    assert [(g[0], g[1]) for g in got] == [(at(2), at(3)), (at(6), at(7))]
    assert "was 1.0 for 1 minutes starting at 2022-01-01 00:02:00 during loadUp event (expected 2.0)" in got[0][5]
    assert "was nan for 1 minutes" in got[1][5] and "during normal operation (expected 1.0)" in got[1][5]
    assert found(alarms.flag_schedule_mismatch(df, day, book, windows(spark))) == []


def test_silent_run_has_the_alarm_columns(spark):
    df, day = wide(spark, PowerIn_HP=[0, 0]), days(spark, PowerIn_HP=[0])
    out = alarms.all_alarms(df, day, rules(spark, ("PowerIn_HP", None)))
    assert out.columns == ["site", "start_time_pt", "end_time_pt", "alarm_type", "event_detail", "variable_name", "certainty"]
    assert out.count() == 0


def test_all_alarms_with_system_filter(spark):
    df, day = wide(spark, Temp_DHW=[140] * 12), days(spark, Temp_DHW=[120])
    book = spark.createDataFrame([("Temp_DHW", "TMPRANG", None, None, None, None, "DHW")], RULES)
    assert alarms.all_alarms(df, day, book, system="DHW").count() == 1
    assert alarms.all_alarms(df, day, book, system="HVAC").count() == 0


def test_rules_need_their_columns(spark):
    with pytest.raises(ValueError, match="alarm_codes"):
        alarms.flag_short_cycle(None, None, spark.createDataFrame([("x",)], "variable_name string"))


def test_rules_that_need_one_power_or_total_fail_without(spark):
    df = wide(spark, PowerIn_A=[0, 2], PowerIn_B=[2, 0], Temp_On=[100, 100], Temp_Off=[140, 140])
    two = rules(spark, ("PowerIn_A", "SOOCHNG"), ("PowerIn_B", "SOOCHNG"), ("Temp_On", "SOOCHNG_ON"), ("Temp_Off", "SOOCHNG_OFF"))
    with pytest.raises(Exception, match="one power variable"):
        alarms.flag_soo_change(df, days(spark, PowerIn_A=[1]), two, windows(spark)).collect()
    day = days(spark, PowerIn_HPWH1=[50.0] * 7, PowerIn_SwingTank=[50.0] * 7)
    with pytest.raises(Exception, match="POWRRAT needs one total"):
        alarms.flag_power_ratio(None, day, rules(spark, ("PowerIn_SwingTank", "POWRRAT:5-30")), days=1).collect()
    with pytest.raises(Exception, match="HPOUTGE needs one total"):
        alarms.flag_outage(df, day, rules(spark, ("PowerIn_HPWH1", "HPOUTGE"))).collect()


BAD_RULES = {
    "more than one colon": [("Temp_A", "TMPRANG:1:2")],
    "written low-high": [("COP_A", "ABNRMCP:3")],
    "Improper variable name": [("Temp", "TMPRANG")],
    "several codes of SHRTCYC": [("PowerIn_A", "SHRTCYC:1;SHRTCYC:2")],
    "HPINLET needs a power and a temperature for element HP": [("PowerIn_HP", "HPINLET")],
    "HPOUTLT needs a power and a temperature for element HP": [("Temp_HP_Outlet", "HPOUTLT")],
    "TMNSTPT needs a power and a temperature for element A": [("Temp_A_Inlet", "TMNSTPT"), ("Temp_A_Outlet", "TMNSTPT")],
    "IMBCKUP: one total power at most": [("PowerIn_Total", "IMBCKUP"), ("PowerIn_Total_B", "IMBCKUP")],
    "BALVALV: needs power, and heat or one total": [("PowerIn_ER", "BALVALV")],
    "is not a power variable": [("Temp_A", "POWRRAT:1-2")],
    "POWRRAT needs one total": [("PowerIn_SwingTank", "POWRRAT:5-30")],
    "HPOUTGE needs one total": [("PowerIn_HPWH1", "HPOUTGE")],
    "SOOCHNG needs one power variable": [("Temp_On", "SOOCHNG_ON"), ("Temp_Off", "SOOCHNG_OFF")],
    "an ON and an OFF temperature for shed": [("PowerIn_HP", "SOOCHNG"), ("Temp_On", "SOOCHNG_ON_shed")],
    "neither a power nor a temperature": [("Flow_A", "SOOCHNG_ON")],
    "TAG_TYPE or TAG_TYPE_ID": [("mode_A", "SOOSCHD")],
}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_problem_of_the_rules_is_lost(spark, adaptive):
    """Without any reading, each problem alone fails, and all of them together are listed."""
    empty = wide(spark, PowerIn_A=[0]).where("false")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for problem, entries in BAD_RULES.items():
            with pytest.raises(Exception, match=problem):
                alarms.all_alarms(empty, empty, rules(spark, *entries), windows(spark)).collect()
        every = rules(spark, *[e for entries in BAD_RULES.values() for e in entries])
        with pytest.raises(Exception) as caught:
            alarms.all_alarms(empty, empty, every, windows(spark)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    together = {"POWRRAT needs one total", "HPOUTGE needs one total", "more than one colon", "several codes of SHRTCYC", "TAG_TYPE or TAG_TYPE_ID"}
    assert all(p in str(caught.value) for p in together)


def test_large_rule_tables_are_checked_too(spark, monkeypatch):
    from wattloom.operators.alarms import codes, detectors

    monkeypatch.setattr(codes, "LOCAL_RULES", 3)
    monkeypatch.setattr(codes, "LISTED", 2)
    good = [(f"PowerIn_{i}", "SHRTCYC") for i in range(6)]
    assert detectors.book(rules(spark, *good), "SHRTCYC").count() == 6
    bad = [(f"PowerIn{i}", "SHRTCYC") for i in range(5)]
    with pytest.raises(codes.RuleError, match="PowerIn0; .*PowerIn1; and 3 more"):
        detectors.book(rules(spark, *good, *bad), "SHRTCYC")


def test_sites_are_checked_apart(spark):
    schema = "site string, variable_name string, alarm_codes string"
    both = spark.createDataFrame([("a", "PowerIn_HPWH", "HPOUTGE"), ("a", "PowerIn_Total", "HPOUTGE"), ("b", "PowerIn_HPWH", "HPOUTGE")], schema)
    with pytest.raises(Exception, match="HPOUTGE needs one total"):
        alarms.flag_outage(wide(spark, Alarm_A=[0]), days(spark, PowerIn_HPWH=[1]), both).collect()


def test_what_a_sum_leaves_does_not_turn_a_tie(spark):
    mean = (75.91 + 53.92) / 2  # 64.91499999999999
    numbers = spark.createDataFrame([(1, mean, 100.0), (2, 64.914, 100.0), (3, float("inf"), 100.0), (4, None, 100.0)], "i int, power double, limit double")
    said = [r[0] for r in numbers.orderBy("i").select(text.message("IMBCKUP share")).collect()]
    assert [x.split("(")[1].split(")")[0] for x in said] == ["64.92", "64.91", "Infinity", "nan"]

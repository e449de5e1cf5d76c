"""Readers on real files in a temporary folder."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.sources import dispatch, files, logger_csv, payloads, tables, weather


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(tmp_path)
    return write


def t(*parts):
    return datetime(2024, 1, 3, *parts)


def test_plain_csv_of_several_layouts(spark, folder, rows):
    folder("a_20240103000000.csv", "DateTime,p,q\n2024/01/03 00:00:00,1,x\n2024/01/03 00:01:00,,2\nbroken\n")
    base = folder("b_20240103000000.csv", "q,DateTime\n7,2024/01/03 00:02:00\n")
    folder("notes.txt", "DateTime,p\n2024/01/03 00:00:00,9\n")
    df = dispatch.read_raw(spark, "csv", base, "s", name_start=-18, name_end=-4)
    assert rows(df, "ts", "variable", "value") == [
        (t(0, 0), "p", 1.0), (t(0, 0), "q", None), (t(0, 1), "p", None), (t(0, 1), "q", 2.0), (t(0, 2), "q", 7.0)]


def test_dates_in_names_prune_files(spark, folder, rows):
    for day in ("02", "03", "04"):
        base = folder(f"s_202401{day}120000.gz.csv", f"DateTime,p\n2024/01/{day} 12:00:00,1\n")
    df = dispatch.read_raw(spark, "csv", base, "s", start="2024-01-03 12:00:00", end="2024-01-04 12:00:00", name_start=-21, name_end=-7)
    assert rows(df, "ts") == [(t(12),)]


def test_modbus_prefix_minutes_and_hex_names(spark, folder, rows):
    folder("mb-001.65949A00_1.log.csv", '"time(UTC)",sensor 1\n2024-01-03 00:00:10,1\n2024-01-03 00:00:50,3\n')
    base = folder("mb-002.65800000_1.log.csv", "time(UTC),sensor 1\n2023-12-18 00:00:10,1\n")
    df = dispatch.read_raw(spark, "csv_mb", base, "s", start="2024-01-01 00:00:00")
    assert rows(df, "ts", "variable", "value") == [(t(0, 0), "mb-001_sensor_1", 2.0)]
    name = spark.createDataFrame([("mb-022.64C84441_1.log.csv",), ("bad.csv",)], "n string")
    assert rows(name.select(files.name_hex_epoch(F.col("n")).alias("d"))) == [(datetime(2023, 7, 31, 23, 31, 13),), (None,)]


def test_dent_and_flow_preambles(spark, folder, rows):
    dent = "".join(f"line {i},1,2,3\n" for i in range(12)) + "n,d,t,kW\n1,01/03/2024,00:00:30,5\n2,01/03/2024,00:00:40,7\n"
    base = folder("dent/x.csv", dent)
    assert rows(dispatch.read_raw(spark, "csv_dent", base + "/dent", "s"), "ts", "variable", "value") == [(t(0, 0), "kW", 6.0)]
    flow = "a,b\n" * 6 + "Month,Day,Year,Hour,Minute,Second,gpm\n1,3,2024,5,6,7,2.5\n"
    base = folder("flow/x.csv", flow)
    assert rows(dispatch.read_raw(spark, "csv_flow", base + "/flow", "s"), "ts", "variable", "value") == [(t(5, 6), "gpm", 2.5)]


def test_epoch_files(spark, folder, rows):
    # 2024-01-03 08:00:00 UTC is midnight on the Pacific coast
    base = folder("msa/dev.csv", "DateEpoch(secs),flow *1\n1704268800,4\n1704268860,6\n")
    got = rows(dispatch.read_raw(spark, "csv_msa", base + "/msa", "s", device_prefix=True), "ts", "variable", "value")
    assert got == [(t(0, 0), "devflow__1", 4.0), (t(0, 1), "devflow__1", 6.0)]
    base = folder("eg/e.csv", "Date & Time,kWh\n1704268800,4\n1704268860,6\n1704268920,\n1704268980,9\n")
    got = rows(dispatch.read_raw(spark, "csv_egauge", base + "/eg", "s"), "ts", "value")
    assert got == [(t(0, 0), None), (t(0, 1), 2.0), (t(0, 2), None), (t(0, 3), None)]
    rules = spark.createDataFrame([("p1x", "Temp"), ("p2x", "Temp")], "variable_alias string, variable_name string")
    folder("sp/p1.csv", "DateEpoch(secs),x,unknown\n1704268800,4,1\n")
    base = folder("sp/p2.csv", "DateEpoch(secs),x\n1704268860,6\n")
    got = rows(dispatch.read_raw(spark, "csv_small_planet", base + "/sp", "s", rules=rules), "ts", "variable", "value")
    assert got == [(t(0, 0), "Temp", 4.0), (t(0, 1), "Temp", 6.0)]


def test_json_rounds_up_and_skips_bad_files(spark, folder, rows):
    entry = lambda time, *data: {"device": "d", "connection": "c", "time": time, "sensors": [{"id": i, "data": v} for i, v in data]}
    good = [entry("2024-01-03 18:59:59", ("a", 1.0), ("b", 2.0)), entry("2024-01-03 18:59:59", ("a", 3.0)), entry("2024-01-03 19:10:00", ("a", 5.0))]
    folder("E4_20240103220000.gz", gzip.compress(json.dumps(good).encode()))
    base = folder("E4_20240105220000.gz", gzip.compress(b"not json"))
    folder("E4_20240101220000.gz", gzip.compress(json.dumps([entry("2024-01-01 00:00:00", ("a", 1.0))]).encode()))
    df = dispatch.read_raw(spark, "json", base, "s", start="2024-01-02 00:00:00")
    assert rows(df, "ts", "variable", "value") == [(t(11, 0), "a", 2.0), (t(11, 0), "b", 2.0), (t(11, 10), "a", 5.0)]


def test_payload_shapes(spark, folder, rows):
    shapes = {
        "api_tb": ({"k": [{"ts": 1704268800000, "value": "1.5"}, {"ts": 1704268860000, "value": "on"}]}, [(t(8, 0), "k", 1.5), (t(8, 1), "k", None)]),
        "api_licor": ({"sensors": [{"sensorSerialNumber": "n", "data": [{"records": [[1704268800000, 9]]}, {"records": [[1704268800000, 2], [1704268860000, "x"]]}]}]},
                      [(t(8, 0), "n", 2.0), (t(8, 1), "n", None)]),
        "api_fm": ({"data": {"d": {"s": [{"time": 1704268800, "value": 1}, {"time": 1704268800, "value": 3}]}}}, [(t(8, 0), "s", 2.0)]),
        "api_skycentrics": ({"time": "2024-01-03T18:59:59Z", "sensors": [{"id": "a", "data": 1}]}, [(t(11, 0), "a", 1.0)]),
        "api_bluedot": ([{"timestamp": 1704268800, "device_id": "d", "total": 4.5}], [(t(8, 0), "total_flow", 4.5)]),
    }
    for kind, (payload, want) in shapes.items():
        base = folder(f"{kind}/x.json", json.dumps(payload))
        assert rows(dispatch.read_raw(spark, kind, f"{base}/{kind}", "s"), "ts", "variable", "value") == want, kind


def test_unknown_kind_and_defaults(spark):
    with pytest.raises(ValueError, match="not a recognized kind"):
        dispatch.read_raw(spark, "nothing", "/tmp", "s")
    assert dispatch.time_defaults("csv") == ("DateTime", "yyyy/MM/dd HH:mm:ss")
    assert dispatch.time_defaults("x", "c", "f", use_defaults=False) == ("c", "f")


def test_station_files(spark, folder, rows):
    base = folder("727930-24234-2024.gz", gzip.compress(b"2024 01 03 08   100   -50 10130   180    50     8    -1 -9999\n2024 01 03 09 -9999 -9999 -9999 -9999 -9999 -9999 -9999 -9999\n"))
    got = rows(weather.read_isd_lite(spark, base))
    assert got[0] == ("727930-24234", t(0), 50.0, 23.0, 1013.0, 180.0, pytest.approx(9.7192225), "Eight oktas - 10/10, or OVC", -1.0, None)
    assert got[1][2:] == (None,) * 8


def test_weather_falls_back_when_every_station_is_stale(spark, rows):
    schema = "station string, ts timestamp_ntz, airTemp_F double"
    stations = spark.createDataFrame([("k", t(0), 40.0), ("k", datetime(2024, 1, 20), None)], schema)
    forecast = spark.createDataFrame([("k", t(5), 41.0)], schema)
    assert rows(weather.choose_weather(stations, forecast, "2024-01-21 00:00:00"), "airTemp_F") == [(41.0,)]
    assert len(rows(weather.choose_weather(stations, forecast, "2024-01-05 00:00:00"))) == 2
    empty = stations.where("false")
    assert rows(weather.choose_weather(empty, forecast, "2024-01-05 00:00:00"), "airTemp_F") == [(41.0,)]


def test_forecast_table(spark, rows):
    df = spark.createDataFrame([("k", t(8), 1.5)], "station string, ts timestamp_ntz, temperature_2m float")
    assert rows(weather.forecast_hours(df, "America/Los_Angeles")) == [("k", t(0), 1.5, None)]


def test_file_list_registry_and_unseen(spark, folder, rows):
    base = folder("aq1.csv", "time(UTC),x\n2024-01-03 00:00:00,1\n2024-01-03 05:00:00,2\n")
    folder("aq2.csv", "time(UTC),x\n2024-01-02 00:00:00,1\n")
    listed = files.list_files(spark, base, ".csv", "aq").select("file_name")
    assert rows(listed) == [("aq1.csv",), ("aq2.csv",)]
    known = spark.createDataFrame([("s", "aq2.csv", t(0), t(1))], "site string, file_name string, start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    grown = files.update_registry(known, logger_csv.aqsuite(files.read_lines(spark, base), "s"), "s")
    assert rows(grown) == [("s", "aq1.csv", t(0), t(5)), ("s", "aq2.csv", t(0), t(1))]
    assert len(rows(files.files_since(grown, "s", "2024-01-03"))) == 2


def test_small_tables(spark, folder, rows):
    base = folder("ls.csv", "date,startTime,endTime,event\n1/3/2024,05:00,07:30,shed\n01/04/2024,0:00,1:00,loadUp\n")
    assert rows(tables.read_schedule(spark, base + "/ls.csv", "s"), "event", "start", "end", "seq") == [
        ("loadUp", datetime(2024, 1, 4), datetime(2024, 1, 4, 1), 1), ("shed", t(5), t(7, 30), 0)]
    folder("site.csv", "site,elev\ncomment,feet\na,100\nb,200\n,\n")
    assert rows(tables.read_site_table(spark, base + "/site.csv")) == [("a", "100"), ("b", "200")]
    assert rows(tables.read_site_table(spark, base + "/site.csv", "b")) == [("b", "200")]
    folder("events.csv", "start_time_pt,end_time_pt,event_type,event_detail\n1/3/2024 05:00,2024-01-04,ALARM,x\n")
    assert rows(tables.read_event_log(spark, base + "/events.csv", "s")) == [("s", t(5), datetime(2024, 1, 4), "ALARM", "x")]
    gone = tables.read_event_log(spark, base + "/missing.csv", "s")
    assert gone.count() == 0 and gone.columns[0] == "site"
    folder("vars.csv", "variable_name,lower_bound,alarm_codes\nx,5,TMPRANG\ny,text,\n")
    assert rows(tables.read_rules(spark, base + "/vars.csv")) == [("x", 5.0, "TMPRANG"), ("y", None, None)]


def test_payload_parsers_are_registered():
    assert set(payloads.PARSERS) == {k for k in dispatch.TIME_DEFAULTS if k.startswith("api_")}


def test_a_mark_inside_a_cell_is_no_header(spark, folder, rows):
    base = folder("unit_2024-01-03_log.csv", "time,p\n\"A time of reset\",4\n00:02:00,5\n")
    assert rows(dispatch.read_raw(spark, "csv_nclarity", base, "s"), "ts", "variable", "value") == [(t(0, 2), "p", 5.0)]


def test_dated_preambles_are_no_data(spark, folder, rows):
    dent = "".join(f"line {i},1,2,3\n" for i in range(11)) + "Start,1/1/2024,00:00:00,7\nn,d,t,kW\n1,01/03/2024,00:00:30,5\n"
    base = folder("dent/x.csv", dent)
    assert rows(dispatch.read_raw(spark, "csv_dent", base + "/dent", "s"), "ts", "variable", "value") == [(t(0, 0), "kW", 5.0)]


def test_site_tables_of_several_files(spark, folder, rows):
    for site in ("a", "b"):
        base = folder(f"sites/{site}.csv", f"site,zip\nthe site,its code\n{site},1\n")
    assert rows(tables.read_site_table(spark, base + "/sites"), "site") == [("a",), ("b",)]


def plans(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_one_file_meet_their_header_in_many_parts(spark, rows):
    """A handful of files is no handful of tasks, and a line is cut and its time parsed once."""
    lines = spark.createDataFrame(
        [("a.csv", "Month,Day,Year,Hour,Minute,Second,gpm", 0)] + [("a.csv", f"1,3,2024,5,{m},0,{m}.5", m + 1) for m in range(60)]
        + [("a.csv", "1,3,2024,x,1,0,9", 70), ("a.csv", ' 1 ,3," 2024",6,0,0,"7"', 71), ("none.csv", "1,3,2024,5,1,0,2", 1)],
        "file_name string, value string, pos long")
    head = files.marked_line(lines, *logger_csv.FLOW_PARTS)
    met = files.tabulate(lines, head)
    assert "_part" in met._jdf.queryExecution().analyzed().toString()
    got = logger_csv.flow(lines, "s")
    given = spark.createDataFrame([("a.csv", "h", 0)], "file_name string, header string, header_pos long")
    cut = files.tabulate(lines, given).where("fields[0] > 'a' AND fields[1] > 'b'")
    assert plans(got).count("format_string") == 1 and plans(cut).count("split(value") == 2  # with and without quotes
    assert rows(got, "ts", "variable", "value") == sorted(
        [(t(5, m), "gpm", m + 0.5) for m in range(60)] + [(t(6), "gpm", 7.0)], key=lambda r: tuple(str(x) for x in r))


def test_cells_of_plain_and_quoted_lines(spark, rows):
    texts = ["a, b ,,c", "", '"a,1", "b" ,c ', 'x"y,z', "a,b,", None]
    df = spark.createDataFrame([(x,) for x in texts], "value string").select(files.cells("value").alias("c"))
    assert [r.c for r in df.collect()] == [["a", "b", "", "c"], [""], ["a,1", "b", "c"], ['x"y', "z"], ["a", "b", ""], None]


def test_fields_and_times_of_odd_lines(spark):
    """The short ways through plain lines and usual times give what the long ones give."""
    lines = ["", "  ", "a,b", " a,b ", "a, b,c", "a ,b", ",,", " , ", "a b,c d", "\ta,b", ',"x, y" ,z', " 1,,2 "]
    plain = [(x, [f.strip(" ") for f in x.split(",")]) for x in lines if '"' not in x] + [(',"x, y" ,z', ["", "x, y", "z"])]
    got = dict(tuple(r) for r in spark.createDataFrame(plain, "value string, f array<string>").select("value", files.cells("value")).collect())
    assert got == dict(plain)
    times = {"2024/01/02 03:04:05": datetime(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04:05": datetime(2024, 1, 2, 3, 4, 5),
             "2024/01-02 03:04:05": None, "2024-01/02 03:04:05": None, "2024/13/02 03:04:05": None, "2024/02/30 03:04:05": None,
             " 2024/1/2 03:04:05 ": datetime(2024, 1, 2, 3, 4, 5), "1/2/2024 03:04:05": datetime(2024, 1, 2, 3, 4, 5),
             "1/2/24 03:04:05": datetime(2024, 1, 2, 3, 4, 5), "2024/01/02": datetime(2024, 1, 2), "03:04:05": None, "2024": None, "": None}
    frame = spark.createDataFrame([(t,) for t in times] + [(None,)], "t string")
    assert dict(tuple(r) for r in frame.select("t", files.parse_time(F.col("t"))).collect()) == times | {None: None}
    fields = {"1.5": 1.5, "": None, " ": None, "x": None, "NaN": None, "-Infinity": float("-inf"), "1e3": 1000.0}
    table = spark.createDataFrame([("f", ["T", *fields], ["2024/01/02 03:04:05", *fields])], "file_name string, names array<string>, fields array<string>")
    rows = files.melt(table, files.parse_time(files.cell("T")), ["T"], "s")
    assert {r["variable"]: r["value"] for r in rows.collect()} == fields

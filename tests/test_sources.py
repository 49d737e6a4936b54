import datetime as dt
import json

from pyspark.sql import functions as F

from stratum.sources import city_tsv, scope, station_dly, weather_json


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_weather_json_cases(spark):
    docs = [
        json.dumps({"_city_id": 1, "latitude": 1.5, "current": {"time": "2026-08-01T12:15",
                    "temperature_2m": 20, "is_day": 1, "weather_code": 3}}),
        json.dumps({"_city_id": 2}),
        json.dumps({"_city_id": 3, "current": None}),
        json.dumps({"_city_id": 4, "current": {"time": "not a time", "is_day": 0}}),
        "{broken",
    ]
    out = weather_json.land_weather(weather_json.parse_weather_lines(lines(spark, docs)),
                                    run_id=F.lit("r"), ingested_at=F.lit(dt.datetime(2026, 8, 1)))
    assert out.columns == weather_json.BRONZE_WEATHER_COLUMNS
    rows = {r.city_id: r for r in out.collect()}
    r1 = rows[1]
    assert r1.temperature_2m == 20.0 and r1.is_day is True and r1.weather_code == 3
    assert r1.observation_time == dt.datetime(2026, 8, 1, 12, 15)
    assert rows[2].observation_time is None and rows[2].is_day is None
    assert rows[3].temperature_2m is None
    assert rows[4].observation_time is None and rows[4].is_day is False
    assert rows[None].raw_json == "{broken"  # malformed: kept, all fields NULL
    assert r1.raw_json == docs[0] and r1._ingest_date == dt.date(2026, 8, 1)


def test_city_tsv_cases(spark):
    base = ["5128581", 'New "York"', "New York", "", "40.7", "-74.0", "P", "PPLA", "US", "", "NY",
            "", "", "", "8804190", "", "57", "America/New_York", "2024-01-05"]
    blank = list(base)
    blank[0], blank[14], blank[16], blank[18] = "12", " 12 ", "", "2024-02-30"
    short = ["77"] + base[1:5]
    out = city_tsv.land_city_reference(
        city_tsv.parse_city_lines(lines(spark, ["\t".join(base), "\t".join(blank), "\t".join(short)]))
    )
    rows = {r.geonameid: r for r in out.collect()}
    assert rows[5128581].name == 'New "York"' and rows[5128581].dem == 57
    assert rows[5128581].elevation is None and rows[5128581].population == 8804190
    assert rows[12].population == 12 and rows[12].dem is None and rows[12].source_modified_date is None
    assert rows[5128581].source_modified_date == dt.date(2024, 1, 5)
    assert len(rows) == 3 and rows[5128581].latitude == 40.7
    assert rows[77].latitude == 40.7 and rows[77].timezone is None and rows[77].population is None


def dly(station, year, month, element, cells):
    """cells: dict day -> (value_text5, m, q, s)."""
    body = ""
    for d in range(1, 32):
        v, m, q, s = cells.get(d, ("-9999", " ", " ", " "))
        body += v.rjust(5) + m + q + s
    return f"{station:<11}{year:04d}{month:02d}{element:<4}" + body


def test_fixed_width_edge_cases(spark):
    ln = [
        dly("USW00094728", 2023, 4, "TMAX", {1: ("  123", " ", " ", "S"), 30: (" -012", "T", "X", "0"),
                                             31: ("  999", " ", " ", " ")}),
        dly("USW00094728", 2024, 2, "PRCP", {29: ("    5", " ", " ", " "), 28: ("     ", " ", " ", " ")}),
        dly("USW00094728", 2023, 2, "PRCP", {29: ("    5", " ", " ", " "), 3: ("  abc", " ", " ", " ")}),
        "USW00094728202301TMAX  100",
    ]
    cells = station_dly.unpack_station_cells(lines(spark, ln))
    status = {(r.obs_date, r.element, r.cell_status) for r in cells.filter("cell_status <> 'missing'").collect()}
    assert (None, "TMAX", "bad_date") in status  # April 31
    assert (None, "PRCP", "bad_date") in status  # 2023-02-29
    assert (dt.date(2023, 2, 3), "PRCP", "bad_value") in status
    assert (dt.date(2024, 2, 28), "PRCP", "blank") in status
    ok = {(r.obs_date, r.element): r for r in station_dly.unpack_station_lines(lines(spark, ln)).collect()}
    assert set(ok) == {(dt.date(2023, 4, 1), "TMAX"), (dt.date(2023, 4, 30), "TMAX"), (dt.date(2024, 2, 29), "PRCP")}
    r = ok[(dt.date(2023, 4, 30), "TMAX")]
    assert (r.data_value, r.mflag, r.qflag, r.sflag) == (-12, "T", "X", "0")
    r = ok[(dt.date(2023, 4, 1), "TMAX")]
    assert (r.data_value, r.mflag, r.qflag, r.sflag) == (123, None, None, "S")
    landed = station_dly.land_station_daily(station_dly.unpack_station_lines(lines(spark, ln)))
    assert landed.first()._source_file == "USW00094728.dly" and landed.columns == station_dly.BRONZE_STATION_COLUMNS


def test_pack_unpack_identity(spark):
    from stratum import standins as si

    events = si.table(spark, "/root/testdata/sf0.001", "events")
    packed = si.station_month_lines(events)
    assert packed.filter(F.length("value") != station_dly.LINE_WIDTH).count() == 0
    unpacked = station_dly.unpack_station_lines(packed).select("station_id", "obs_date", "element", "data_value")
    direct = events.groupBy(
        si.station_id(F.col("user_id")).alias("station_id"), F.to_date("ts").alias("obs_date"),
        si._map_col(si.ELEMENT_OF_EVENT, F.col("event_type")).alias("element"),
    ).agg(F.floor(F.max("value") * 10).cast("int").alias("data_value"))
    assert unpacked.exceptAll(direct).count() == 0 and direct.exceptAll(unpacked).count() == 0


def test_scope(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 12, 31)), ("B", dt.date(2021, 1, 1))],
        "station_id string, obs_date date",
    )
    assert scope.scope_dates(df, "2020-01-01", "2020-12-31").count() == 2
    assert scope.scope_dates(df, None, " ").count() == 3
    assert scope.scope_stations(df, ["B"]).count() == 1 and scope.scope_stations(df, [" "]).count() == 3
    scope.check_stations(spark, ["A"], df)
    try:
        scope.check_stations(spark, ["A", "Z"], df)
        raise AssertionError("expected UnknownStation")
    except scope.UnknownStation as e:
        assert "Z" in str(e)


def test_file_readers(spark, tmp_path):
    from stratum.sources.air_quality_json import read_air_quality_json

    d = tmp_path / "dly"
    d.mkdir()
    (d / "USW00000001.dly").write_text(dly("USW00000001", 2024, 1, "TMAX", {5: ("   42", " ", " ", "S")}) + "\n")
    rows = station_dly.read_station_dly(spark, str(d)).collect()
    assert [(r.obs_date, r.data_value, r._source_file) for r in rows] == [
        (dt.date(2024, 1, 5), 42, "USW00000001.dly")
    ]
    a = tmp_path / "aq"
    a.mkdir()
    doc = {"location_id": 7, "coordinates": {"latitude": 1.0, "longitude": 2.0},
           "results": [{"sensor_id": 70, "parameter": {"name": "pm25", "units": "ug/m3"}, "value": 12.5,
                        "period": {"datetimeFrom": {"utc": "2024-01-01T05:00:00Z"},
                                   "datetimeTo": {"utc": "2024-01-01T06:00:00Z"}}},
                       {"sensor_id": 71, "parameter": {"name": "pm10"}, "value": 3}]}
    (a / "x.json").write_text(json.dumps(doc) + "\n" + json.dumps({"location_id": 8}) + "\n")
    out = {(r.location_id, r.sensor_id): r for r in read_air_quality_json(spark, str(a)).collect()}
    assert set(out) == {(7, 70), (7, 71), (8, None)}
    assert out[(7, 70)].period_datetime_from == dt.datetime(2024, 1, 1, 5)
    assert out[(7, 71)].value == 3.0 and out[(7, 71)].parameter_units is None

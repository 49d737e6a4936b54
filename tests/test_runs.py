import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum import standins as si
from stratum.operators.quality import GateClosed
from stratum.plans.dim_city import run_dim_city
from stratum.plans.gold import run_daily_mart, run_weather_fact, touched_days
from stratum.plans.historical import run_silver_historical
from stratum.plans.weather import run_silver_weather
from stratum.sources.city_tsv import read_city_tsv
from stratum.sources.tables import Lakehouse
from stratum.sources.weather_json import land_weather, parse_weather_lines

SF = "/root/testdata/sf0.001"


def test_end_to_end_and_reruns(spark, tmp_root):
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="e2e_")
    lake.create()
    events, customer = si.table(spark, SF, "events"), si.table(spark, SF, "customer")
    si.city_tsv_lines(customer, 1).write.text(f"{tmp_root}/landing/city1")
    lake.append(read_city_tsv(spark, f"{tmp_root}/landing/city1", run_id=F.lit("c1"),
                              ingested_at=F.lit(dt.datetime(2024, 1, 1))), "bronze.city_reference_raw")
    assert run_dim_city(lake, dt.datetime(2024, 1, 1, 1))["changed_or_new_cities"] > 0
    assert run_dim_city(lake, dt.datetime(2024, 1, 1, 2))["changed_or_new_cities"] == 0

    lake.append(land_weather(parse_weather_lines(si.weather_json_lines(events)), run_id=F.lit("w1")),
                "bronze.weather_raw")
    r = run_silver_weather(lake, dt.datetime(2024, 1, 31, 1), as_of="_ingested_at")
    silver_n = lake.table("silver.weather_observations").count()
    assert r["checked_rows"] == events.count() and silver_n > 0
    again = run_silver_weather(lake, dt.datetime(2024, 1, 31, 2), as_of="_ingested_at")
    assert again["checked_rows"] == 0 and lake.table("silver.weather_observations").count() == silver_n

    days = touched_days(r["touched_partitions"])
    run_daily_mart(lake, days)
    run_weather_fact(lake, days)
    fact = lake.table("gold.fact_weather_observation")
    before = {(x.city_id, x.observation_timestamp, x._source): x.weather_observation_sk for x in fact.collect()}
    run_weather_fact(lake, days)
    after = {(x.city_id, x.observation_timestamp, x._source): x.weather_observation_sk
             for x in lake.table("gold.fact_weather_observation").collect()}
    assert before == after and len(set(after.values())) == len(after)
    mart = lake.table("gold.mart_daily_city_climate_summary")
    assert mart.groupBy("city_id", "obs_date").count().filter("count > 1").count() == 0
    assert mart.agg(F.sum("row_count")).first()[0] == silver_n


def test_gate_fails_after_writes(spark, tmp_root):
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="gate_")
    lake.create()
    events = si.table(spark, SF, "events")
    lake.append(land_weather(parse_weather_lines(si.weather_json_lines(events)), run_id=F.lit("w1")),
                "bronze.weather_raw")
    # Empty city dimension: every reading is an orphan.
    with pytest.raises(GateClosed):
        run_silver_weather(lake, dt.datetime(2024, 1, 31, 1), as_of="_ingested_at")
    assert lake.table("silver.dq_quarantine").count() == events.count()
    log = lake.table("ops.run_log").first()
    assert log.status == "gate_failed"


def test_historical_backfill_twice_keeps_silver(spark, tmp_root):
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="hist_")
    lake.create()
    events = si.table(spark, SF, "events")
    bronze = si.bronze_station_daily(events)
    lake.append(bronze, "bronze.ghcn_daily_raw")
    run_silver_historical(lake, dt.datetime(2024, 2, 1))
    n = lake.table("silver.historical_daily_weather").count()
    # land the same history again under a new run: silver must not change
    lake.append(bronze.withColumn("_ingestion_run_id", F.concat(F.lit("again-"), F.col("_ingestion_run_id"))),
                "bronze.ghcn_daily_raw")
    second = run_silver_historical(lake, dt.datetime(2024, 2, 2))
    assert second["checked_rows"] == bronze.count()  # the re-landed run was processed
    assert lake.table("silver.historical_daily_weather").count() == n


def test_air_quality_health_and_dates(spark, tmp_root):
    from stratum.plans.air_quality import run_air_quality_marts, run_silver_air_quality
    from stratum.plans.gold import run_air_quality_fact
    from stratum.plans.health import run_dim_date, run_pipeline_health

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="aq_")
    lake.create()
    events, customer = si.table(spark, SF, "events"), si.table(spark, SF, "customer")
    lake.append(si.bronze_city_snapshot(customer, 1), "bronze.city_reference_raw")
    run_dim_city(lake, dt.datetime(2024, 1, 1, 1))
    lake.append(land_weather(parse_weather_lines(si.weather_json_lines(events)), run_id=F.lit("w1")),
                "bronze.weather_raw")
    wx = run_silver_weather(lake, dt.datetime(2024, 1, 31, 1), as_of="_ingested_at")
    lake.append(si.bronze_air_quality(events), "bronze.air_quality_raw")
    r = run_silver_air_quality(lake, dt.datetime(2024, 1, 31, 2))
    silver = lake.table("silver.air_quality_readings")
    assert r["rows"] == events.count() and silver.count() > 0
    assert silver.filter("city_id IS NULL").count() == 0
    assert run_silver_air_quality(lake, dt.datetime(2024, 1, 31, 3))["rows"] == 0
    days = touched_days(wx["touched_partitions"])
    assert run_air_quality_fact(lake, days) > 0
    fact = lake.table("gold.fact_air_quality_reading")
    assert fact.select("air_quality_reading_sk").distinct().count() == fact.count()
    run_air_quality_marts(lake, days)
    mart = lake.table("gold.mart_daily_city_climate_summary")
    assert mart.filter("dominant_aqi_category IS NOT NULL").count() > 0
    assert run_pipeline_health(lake) >= 1
    health = lake.table("gold.mart_pipeline_health")
    assert health.filter("rows_processed > 0").count() == health.count()
    assert run_dim_date(lake, "2024-01-01", "2024-12-31") == 366


def test_hourly_chain_from_files(spark, tmp_root):
    import json

    from stratum.plans.hourly import run_weather_hourly

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="hr_")
    lake.create()
    spark.sql(
        f"INSERT INTO {lake.name('silver.dim_city')} VALUES (1, 1, 'A', 'a', 'US', 'NY', 0.0, 0.0, 5, 10, 'z',"
        " TIMESTAMP '2024-01-01 00:00:00', NULL, true)"
    )
    now = dt.datetime(2024, 3, 1, 12, 0)
    docs = [json.dumps({"_city_id": 1, "current": {"time": f"2024-03-01T{h:02d}:00", "temperature_2m": h,
                                                   "precipitation": 0.5}}) for h in range(10, 12)]
    landing = f"{tmp_root}/landing/h1"
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(landing)
    out = run_weather_hourly(lake, landing, run_id="h1", run_ts=now)
    assert out["checked_rows"] == 2 and out["mart_partitions"] == 1
    mart = lake.table("gold.mart_daily_city_climate_summary").first()
    assert (mart.row_count, mart.total_precip_mm, mart.avg_temp_c) == (2, 1.0, 10.5)
    assert lake.table("gold.mart_pipeline_health").count() == 1


def test_lakehouse_refuses_tables_of_another_root(spark, tmp_root):
    Lakehouse(spark, f"{tmp_root}/one", prefix="guard_").create()
    Lakehouse(spark, f"{tmp_root}/one", prefix="guard_").create()  # same root: idempotent
    with pytest.raises(ValueError):
        Lakehouse(spark, f"{tmp_root}/two", prefix="guard_").create()


def _city(spark, lake, ids=(1,)):
    for i in ids:
        spark.sql(f"INSERT INTO {lake.name('silver.dim_city')} VALUES ({i}, {i}, 'A', 'a', 'US', 'NY', 0.0, 0.0, 5, 10, 'z',"
                  " TIMESTAMP '2024-01-01 00:00:00', NULL, true)")


def _land(spark, lake, run, at, docs):
    import json

    lines = spark.createDataFrame([(json.dumps({"_city_id": c, "current": {"time": t, "temperature_2m": v, "precipitation": p}}),)
                                   for c, t, v, p in docs], "value string")
    lake.append(land_weather(parse_weather_lines(lines), run_id=F.lit(run), ingested_at=F.lit(at)), "bronze.weather_raw")


def test_late_older_landing_changes_nothing(spark, tmp_root):
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="late_")
    lake.create()
    _city(spark, lake)
    day = dt.datetime(2024, 3, 2, 12)
    _land(spark, lake, "noon", day, [(1, "2024-03-02T10:00", 12.0, 0.00004), (1, "2024-03-02T10:00", 12.0, 0.00004)])
    first = run_silver_weather(lake, day)
    assert (first["checked_rows"], first["merged_rows"]) == (2, 1)
    _land(spark, lake, "eleven", day - dt.timedelta(hours=1), [(1, "2024-03-02T10:00", 11.0, 0.5), (1, "2024-03-02T09:00", 9.0, 0.0)])
    run_silver_weather(lake, day + dt.timedelta(hours=1))
    silver = {r.observation_timestamp.hour: r.temperature_c for r in lake.table("silver.weather_observations").collect()}
    assert silver == {10: 12.0, 9: 9.0}
    run_daily_mart(lake, [day.date()])
    assert lake.table("gold.mart_daily_city_climate_summary").first().total_precip_mm == 0.00004
    assert run_daily_mart(lake, []) == 0  # no days is not all days


def test_gold_catches_up_after_a_gate_failure(spark, tmp_root):
    from stratum.plans.hourly import run_weather_hourly

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="catch_")
    lake.create()
    _city(spark, lake)
    now = dt.datetime(2024, 3, 3, 12)
    _land(spark, lake, "bad", now, [(1, "2024-03-02T10:00", 5.0, 0.1), (77, "2024-03-02T10:00", 5.0, 0.1)])
    with pytest.raises(GateClosed):
        run_weather_hourly(lake, run_ts=now)
    health = {r.run_id: r.rows_quarantined for r in lake.table("gold.mart_pipeline_health").collect()}
    assert health == {"bad": 1} and lake.table("gold.mart_daily_city_climate_summary").count() == 0
    _land(spark, lake, "good", now, [(1, "2024-03-03T10:00", 6.0, 0.1)])
    out = run_weather_hourly(lake, run_ts=now + dt.timedelta(minutes=5))
    assert out["mart_partitions"] == 2
    days = sorted(r.obs_date.day for r in lake.table("gold.mart_daily_city_climate_summary").collect())
    assert days == [2, 3] and lake.table("gold.fact_weather_observation").count() == 2
    again = run_weather_hourly(lake, run_ts=now + dt.timedelta(minutes=10))
    assert again["mart_partitions"] == 0


def _aq(spark, lake, run, at, rows):
    df = spark.createDataFrame([(*r, run, at) for r in rows], "location_id bigint, parameter_name string, parameter_units string, value double, "
                               "period_datetime_from timestamp, _ingestion_run_id string, _ingested_at timestamp")
    lake.append(df.select("*", F.lit("openaq").alias("_source"), F.to_date("_ingested_at").alias("_ingest_date"), F.lit(1).cast("bigint").alias("sensor_id"),
                          F.lit(None).cast("string").alias("raw_json"), F.lit(None).cast("timestamp").alias("period_datetime_to"),
                          F.lit(0.0).alias("location_latitude"), F.lit(0.0).alias("location_longitude")), "bronze.air_quality_raw")


def test_air_quality_keeps_the_worst_and_quarantines_the_unusable(spark, tmp_root):
    from stratum.plans.air_quality import run_air_quality_marts, run_silver_air_quality
    from stratum.plans.hourly import run_weather_hourly

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="worst_")
    lake.create()
    _city(spark, lake)
    now = dt.datetime(2024, 3, 2, 23)
    hour = lambda h: dt.datetime(2024, 3, 2, h)
    _aq(spark, lake, "aq1", now, [(1, "pm25", "µg/m³", 5.0, hour(1)), (1, "pm25", "µg/m³", 400.0, hour(2)), (1, "pm25", "µg/m³", 400.0, hour(3)),
                                  (1, "pm25", "µg/m³", 7.0, None), (1, "pm25", "µg/m³", 8.0, None), (1, "pm25", "µg/m³", -1.0, hour(4))])
    with pytest.raises(GateClosed):
        run_silver_air_quality(lake, now)
    assert lake.table("silver.air_quality_readings").count() == 3
    reasons = sorted(r.failure_reason for r in lake.table("silver.dq_quarantine").collect())
    assert reasons == ["not_null_observation_timestamp"] * 2 + ["value_non_negative"]
    _land(spark, lake, "w1", now, [(1, "2024-03-02T10:00", 5.0, 0.1)])
    run_silver_weather(lake, now)
    run_air_quality_marts(lake, [now.date()])
    row = lake.table("gold.mart_weather_air_quality_correlation").first()
    assert row.avg_aqi == pytest.approx((28 + 500 + 500) / 3) and row.avg_pm25 == pytest.approx(805 / 3)
    _land(spark, lake, "w2", now, [(1, "2024-03-02T11:00", 7.0, 0.1)])
    run_weather_hourly(lake, run_ts=now + dt.timedelta(minutes=1))
    mart = lake.table("gold.mart_daily_city_climate_summary").first()
    assert (mart.row_count, mart.dominant_aqi_category) == (2, "Hazardous")


def test_staged_files_go_and_city_run_counts(spark, tmp_root):
    from stratum.plans.dim_city import run_city_reference
    from stratum.session import ensure_checkpoint_dir

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="stage_")
    lake.create()
    customer = si.table(spark, SF, "customer")
    si.city_tsv_lines(customer, 1).write.text(f"{tmp_root}/landing/city1")
    out = run_city_reference(lake, f"{tmp_root}/landing/city1", run_ts=dt.datetime(2024, 1, 1))
    assert out["landed_rows"] == out["changed_or_new_cities"] > 0
    again = run_city_reference(lake, f"{tmp_root}/landing/city1", run_ts=dt.datetime(2024, 1, 2))
    assert again["changed_or_new_cities"] == 0
    path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark) + "/stage")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(path) or len(fs.listStatus(path)) == 0


def test_backfill_of_one_station_rewrites_one_bucket_a_year(spark, tmp_root):
    from stratum.plans.historical import STATION_BUCKETS
    from stratum.sources.tables import partition_filter

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="bucket_")
    lake.create()
    bronze = si.bronze_station_daily(si.table(spark, SF, "events"))
    lake.append(bronze, "bronze.ghcn_daily_raw")
    run_silver_historical(lake, dt.datetime(2024, 2, 1))
    silver = "silver.historical_daily_weather"
    files = lambda: set(lake.table(silver).inputFiles())
    before, rows = files(), lake.table(silver).drop("_merged_at", "_ingested_at").collect()
    station = lake.table(silver).first()["station_id"]
    again = bronze.where(F.col("station_id") == station).withColumns({
        "_ingestion_run_id": F.lit("one-station"), "_ingested_at": F.expr("_ingested_at + INTERVAL 1 YEAR")})
    lake.append(again, "bronze.ghcn_daily_raw")
    out = run_silver_historical(lake, dt.datetime(2024, 2, 2))
    years = {year for year, _ in out["touched_partitions"]}
    assert len(out["touched_partitions"]) == len(years) and len({b for _, b in out["touched_partitions"]}) == 1
    (bucket,) = {b for _, b in out["touched_partitions"]}
    assert all(f"station_bucket={bucket}/" in f for f in before ^ files())
    assert sum(f"station_bucket={bucket}/" not in f for f in before & files()) >= min(STATION_BUCKETS, len(before)) // 2
    assert sorted(map(str, lake.table(silver).drop("_merged_at", "_ingested_at").collect())) == sorted(map(str, rows))
    touched = lake.table(silver).where(partition_filter(("obs_year", "station_bucket"), out["touched_partitions"]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "station_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_station_backfill_counts_bad_cells_and_refuses_unknown_stations(spark, tmp_root):
    from stratum.plans.historical import run_station_backfill

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="back_")
    lake.create()
    cells = ["   12 X ", "  abc   ", "-9999   "] + ["-9999   "] * 28
    line = "ST000000001" + "202401" + "TMAX" + "".join(cells)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{tmp_root}/dly")
    with pytest.raises(ValueError):
        run_station_backfill(lake, f"{tmp_root}/dly", stations=["ST000000002"])
    out = run_station_backfill(lake, f"{tmp_root}/dly", stations=["ST000000001"], run_ts=dt.datetime(2024, 2, 1))
    assert out["checked_rows"] == 1 and out["landed_cells"]["bad_value"] == 1
    log = {r.task_id: r for r in lake.table("ops.run_log").collect()}
    assert log["land_stations"].rows_quarantined == 1 and log["silver_historical"].rows_processed == 1


def test_unseen_prunes_bronze_at_run_time_and_settles_missing_run_ids(spark, tmp_root):
    from stratum.plans import runlog

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="reg_")
    lake.create()
    events = si.table(spark, SF, "events")
    assert lake.append(si.bronze_station_daily(events), "bronze.ghcn_daily_raw") == events.count()
    without = si.bronze_station_daily(events.limit(5)).withColumn("_ingestion_run_id", F.lit(None).cast("string"))
    assert lake.append(without, "bronze.ghcn_daily_raw") == 5
    log = lake.table("ops.landing_log")
    assert log.where("run_id IS NULL").count() == 0 and log.where("run_id LIKE 'landing-%'").count() > 0
    fresh = runlog.unseen("bronze.ghcn_daily_raw", lake, "silver_historical")
    assert fresh.count() == events.count() + 5
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    run_silver_historical(lake, dt.datetime(2024, 2, 1))
    assert runlog.unseen("bronze.ghcn_daily_raw", lake, "silver_historical").count() == 0
    assert runlog.register(lake, "bronze.ghcn_daily_raw") == 0


def test_air_quality_chain_catches_up_after_a_closed_gate(spark, tmp_root):
    import json

    from stratum.plans import derived, runlog
    from stratum.plans.air_quality import run_air_quality_hourly

    assert derived.order().index("daily_state") < derived.order().index("daily_mart")
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="aqc_")
    lake.create()
    _city(spark, lake)
    now = dt.datetime(2024, 3, 2, 23)
    _land(spark, lake, "w1", now, [(1, "2024-03-02T10:00", 5.0, 0.1)])
    run_silver_weather(lake, now)

    def document(day, value):
        period = {"datetimeFrom": {"utc": f"2024-03-{day:02d}T01:00:00Z"}, "datetimeTo": {"utc": f"2024-03-{day:02d}T02:00:00Z"}}
        return json.dumps({"location_id": 1, "coordinates": {"latitude": 1.0, "longitude": 1.0},
                           "results": [{"sensor_id": 1, "parameter": {"name": "pm25", "units": "µg/m³"}, "value": value, "period": period}]})

    def land(name, docs):
        spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(f"{tmp_root}/{name}")
        return f"{tmp_root}/{name}"

    with pytest.raises(GateClosed):
        run_air_quality_hourly(lake, land("bad", [document(2, 5.0), document(2, -1.0)]), run_id="bad", run_ts=now)
    assert lake.table("gold.fact_air_quality_reading").count() == 0
    assert lake.table("gold.mart_weather_air_quality_correlation").count() == 0
    out = run_air_quality_hourly(lake, land("good", [document(3, 400.0)]), run_id="good", run_ts=now + dt.timedelta(minutes=5))
    assert out["landed_rows"] == 1 and out["air_quality_fact"] == 2
    assert sorted(r.air_quality_reading_sk for r in lake.table("gold.fact_air_quality_reading").collect()) == [1, 2]
    mart = lake.table("gold.mart_weather_air_quality_correlation").collect()
    assert [(r.obs_date.day, r.avg_pm25, r.avg_temp_c) for r in mart] == [(2, 5.0, 5.0)]
    assert lake.table("gold.mart_daily_city_climate_summary").first().dominant_aqi_category == "Good"
    assert all(runlog.owed_days(lake, name) == [] for name in derived.order())
    assert lake.table("silver.location_city").first().city_id == 1 and lake.table("ops.indexed_city").count() == 1
    again = run_air_quality_hourly(lake, run_ts=now + dt.timedelta(minutes=9))
    assert again["air_quality_fact"] == again["weather_aq_mart"] == 0 and spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_states_that_a_run_left_behind_are_made_anew(spark, tmp_root):
    from stratum.plans import runlog
    from stratum.plans.derived import catch_up

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="left_")
    lake.create()
    _city(spark, lake)
    now = dt.datetime(2024, 3, 2, 12)
    _land(spark, lake, "a", now, [(1, "2024-03-02T10:00", 5.0, 0.1), (1, "2024-03-02T11:00", 9.0, 0.1)])
    run_silver_weather(lake, now)
    # as after a crash between silver and its states: the day is owed, the state wrong
    lake.replace(lake.table("gold.daily_weather_state").withColumn("row_count", F.lit(99).cast("bigint")), "gold.daily_weather_state")
    runlog.owe(lake, ["daily_state"], [now.date()])
    _land(spark, lake, "b", now + dt.timedelta(hours=1), [(1, "2024-03-02T11:00", 1.0, 0.2)])
    run_silver_weather(lake, now + dt.timedelta(hours=1))
    assert catch_up(lake)["daily_mart"] == 1
    row = lake.table("gold.mart_daily_city_climate_summary").first()
    assert (row.row_count, row.min_temp_c, row.max_temp_c, row.avg_temp_c) == (2, 1.0, 5.0, 3.0)

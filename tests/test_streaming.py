import datetime as dt
import json
import os

from stratum.sources.tables import Lakehouse
from stratum.streaming.incremental import start_weather_stream


BASE = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, second=0, microsecond=0) - dt.timedelta(hours=2)


def _doc(city, minute):
    t = (BASE + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M")
    return json.dumps({"_city_id": city, "current": {"time": t, "temperature_2m": 1.5}})


def test_stream_lands_each_file_once(spark, tmp_root):
    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="strm_")
    lake.create()
    spark.sql(
        f"INSERT INTO {lake.name('silver.dim_city')} VALUES (1, 1, 'A', 'a', 'US', 'NY', 0.0, 0.0, 5, 10, 'z',"
        " TIMESTAMP '2024-01-01 00:00:00', NULL, true)"
    )
    landing, ckpt = f"{tmp_root}/landing", f"{tmp_root}/stream-ckpt"
    os.makedirs(landing)
    with open(f"{landing}/a.json", "w") as f:
        f.write("\n".join([_doc(1, 0), _doc(1, 15), _doc(1, 30)]) + "\n")
    start_weather_stream(lake, landing, ckpt, as_of="_ingested_at").awaitTermination(120)
    assert lake.table("bronze.weather_raw").count() == 3
    assert lake.table("silver.weather_observations").count() == 3
    # a second trigger with no new file changes nothing
    start_weather_stream(lake, landing, ckpt, as_of="_ingested_at").awaitTermination(120)
    assert lake.table("bronze.weather_raw").count() == 3
    with open(f"{landing}/b.json", "w") as f:
        f.write("\n".join([_doc(1, 45), _doc(1, 30)]) + "\n")
    start_weather_stream(lake, landing, ckpt, as_of="_ingested_at").awaitTermination(120)
    assert lake.table("bronze.weather_raw").count() == 5
    # the re-sent 00:30 reading replaces the earlier one (latest ingest wins)
    assert lake.table("silver.weather_observations").count() == 4
    log = lake.table("ops.run_log")
    assert log.filter("task_id = 'land_weather' AND status = 'ok'").count() == 2
    assert log.filter("task_id = 'silver_weather' AND status = 'ok'").count() == 2


def test_replay_after_the_append_does_not_land_twice(spark, tmp_root):
    from pyspark.sql import functions as F

    from stratum.sources.weather_json import land_weather, parse_weather_lines
    from stratum.streaming.incremental import _log_landing, weather_batch

    lake = Lakehouse(spark, f"{tmp_root}/lake", prefix="replay_")
    lake.create()
    batch = spark.createDataFrame([(_doc(1, 0),), (_doc(1, 15),)], "value string")
    _log_landing(lake, "s-0", BASE, "started")  # the first attempt died between append and log
    lake.append(land_weather(parse_weather_lines(batch), run_id=F.lit("s-0"), ingested_at=F.lit(BASE)), "bronze.weather_raw")
    process = weather_batch(lake, "s", promote=False)
    process(batch, 0)
    process(batch, 0)
    process(batch, 1)
    assert lake.table("bronze.weather_raw").groupBy("_ingestion_run_id").count().collect() and lake.table("bronze.weather_raw").count() == 4
    ok = lake.table("ops.run_log").where("status = 'ok'").collect()
    assert sorted((r.run_id, r.rows_processed) for r in ok) == [("s-0", 2), ("s-1", 2)]

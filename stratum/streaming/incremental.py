"""Land and promote newly arrived weather documents, once each.

A file-source stream over the landing folder sees every file exactly once
(its checkpoint records which files were taken). Each micro-batch is landed
into bronze under a run id derived from the batch id and the silver run is
applied to the unseen landing runs. With ``availableNow`` the query drains
what has landed and stops, so the hourly cadence is the scheduler's trigger.

A batch is noted as started before and as ok after its append to bronze. A
replayed micro-batch that was started looks for its rows in bronze and lands
only if there are none; silver is keyed and idempotent anyway.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.plans import runlog
from stratum.plans.weather import run_silver_weather
from stratum.sources.tables import Lakehouse
from stratum.sources.weather_json import land_weather, parse_weather_lines

LANDING_TASK = "land_weather"


def _log_landing(lake: Lakehouse, run_id: str, at: dt.datetime, status: str, rows: int = 0, newest=None) -> None:
    runlog.record(lake, "weather_stream", LANDING_TASK, at, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                  [{"_ingestion_run_id": run_id, "rows_processed": rows, "rows_quarantined": 0, "max_observation_ts": newest,
                    "first_ingested_at": at}], status)


def weather_batch(lake: Lakehouse, stream_name: str, as_of: str | None = None, promote: bool = True):
    """The ``foreachBatch`` function: land the batch, then promote to silver."""

    def process(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{stream_name}-{batch_id}"
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        log = lake.table("ops.run_log").where((F.col("task_id") == LANDING_TASK) & (F.col("run_id") == run_id))
        known = {r["status"] for r in log.select("status").distinct().collect()}
        if "ok" not in known:
            landed = lake.table("bronze.weather_raw").where(F.col("_ingestion_run_id") == run_id)
            if "started" not in known:
                _log_landing(lake, run_id, now, "started")
            # only a batch that was begun before can lie in bronze already
            if "started" not in known or landed.isEmpty():
                lake.append(land_weather(parse_weather_lines(batch), run_id=F.lit(run_id), ingested_at=F.lit(now)), "bronze.weather_raw")
                landed = lake.table("bronze.weather_raw").where((F.col("_ingest_date") == F.lit(now.date())) & (F.col("_ingestion_run_id") == run_id))
            counts = landed.agg(F.count("*").alias("n"), F.max("observation_time").cast("timestamp").alias("newest")).first()
            _log_landing(lake, run_id, now, "ok", counts["n"], counts["newest"])
        if promote:
            run_silver_weather(lake, now, as_of=as_of)

    return process


def start_weather_stream(
    lake: Lakehouse,
    landing_dir: str,
    checkpoint_location: str,
    stream_name: str = "weather",
    as_of: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    promote: bool = True,
) -> StreamingQuery:
    """Start the incremental landing stream; ``checkpoint_location`` must be
    on shared storage on a cluster (it is the stream's memory of files)."""
    reader = lake.spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir)
    writer = (
        lines.writeStream.foreachBatch(weather_batch(lake, stream_name, as_of, promote))
        .option("checkpointLocation", checkpoint_location)
        .queryName(f"stratum-{stream_name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()

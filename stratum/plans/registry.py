"""Registered queries: each maps the driver's tables onto a reference role
(see :mod:`stratum.standins`) and runs the library operators over the whole
tables. ``__spark_entry__`` exposes them; ``stratum.plans.oracle`` holds the
equivalent DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import standins as si
from stratum.operators import quality as q
from stratum.operators.marts import daily_city_summary
from stratum.plans import weather as wx

# Run timestamps used by the registered queries, so results
# never depend on the wall clock.
MERGED_AT = "2024-02-01 00:00:00"
QUARANTINED_AT = "2024-02-01 00:05:00"
# Decimal places that hold every digit of the stand-in readings, so
# that sums agree to the last bit with those of another engine.
SCALE = 4
# Freshness is judged at landing here.
WEATHER_RULES = wx.weather_rules("_ingested_at")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _inputs(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [si.table(spark, sf_dir, n) for n in names]


# ------------------------------------------------------------ weather silver

def _marked_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customer = _inputs(spark, sf_dir, "events", "customer")
    return WEATHER_RULES.mark(wx.weather_candidates(si.bronze_weather(events), si.dim_city_ids_v1(customer)))


def dq_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WEATHER_RULES.passed(_marked_weather(spark, sf_dir)).drop(wx.KNOWN_CITY)


def dq_split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WEATHER_RULES.failed(_marked_weather(spark, sf_dir)).drop(wx.KNOWN_CITY)


def quarantine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine rows; the JSON record text is engine-formatted, so the
    compared projection leaves it out (pytest checks it round-trips)."""
    rec = q.quarantine_records(
        dq_split_invalid(spark, sf_dir),
        "silver.weather_observations",
        wx.WEATHER_KEYS,
        quarantined_at=_ts(QUARANTINED_AT),
    )
    return rec.drop("raw_record")


def dq_gate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wx.WEATHER_GATE.report(_marked_weather(spark, sf_dir))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wx.silver_weather(dq_split_valid(spark, sf_dir), _ts(MERGED_AT))


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: bronze -> checks -> dedup -> daily mart with names."""
    customer = si.table(spark, sf_dir, "customer")
    return daily_city_summary(dedup_latest(spark, sf_dir), si.dim_city_ids_v1(customer), sum_scale=SCALE)


# ------------------------------------------------------------ sources

def land_weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents as JSON text -> parsed, audited bronze rows. The raw
    line is kept on the bronze row; the compared projection drops it."""
    from stratum.sources.weather_json import land_weather, parse_weather_lines

    events = si.table(spark, sf_dir, "events")
    bronze = land_weather(parse_weather_lines(si.weather_json_lines(events)), run_id=F.lit("json-run-1"))
    return bronze.drop("raw_json").withColumn(
        "observation_time", F.col("observation_time").cast("timestamp_ntz")
    )


def land_city_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.sources.city_tsv import land_city_reference, parse_city_lines

    customer = si.table(spark, sf_dir, "customer")
    run_id, ingested_at = si.CITY_RUNS[1]
    return land_city_reference(
        parse_city_lines(si.city_tsv_lines(customer, 1, whole=True)), run_id=F.lit(run_id), ingested_at=_ts(ingested_at)
    )


def unpack_station_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.sources.station_dly import land_station_daily, unpack_station_lines

    events = si.table(spark, sf_dir, "events")
    return land_station_daily(
        unpack_station_lines(si.station_month_lines(events)),
        run_id=F.lit("dly-run-1"),
        ingested_at=_ts(MERGED_AT),
    )


def scope_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.sources.scope import scope_dates, scope_stations

    events = si.table(spark, sf_dir, "events")
    return scope_stations(scope_dates(si.bronze_station_daily(events), "2024-01-05", "2024-01-20"), None)


def shape_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.shaping import shape_station_daily

    return shape_station_daily(si.bronze_station_daily(si.table(spark, sf_dir, "events")))


# ------------------------------------------------------------ upsert, facts

def _silver_window(spark: SparkSession, sf_dir: str, last_day: str | None, first_day: str | None,
                   bump: float, merged_at: str) -> DataFrame:
    events, customer = _inputs(spark, sf_dir, "events", "customer")
    day = F.to_date("ts")
    if last_day:
        events = events.filter(day <= F.to_date(F.lit(last_day)))
    if first_day:
        events = events.filter(day >= F.to_date(F.lit(first_day)))
    events = events.withColumn("value", F.col("value") + F.lit(bump))
    valid, _ = wx.split_weather(si.bronze_weather(events), si.dim_city_ids_v1(customer), as_of="_ingested_at")
    return wx.silver_weather(valid, _ts(merged_at))


# The two overlapping batches of the upsert stand-in.
TARGET_LAST_DAY, SOURCE_FIRST_DAY = "2024-01-20", "2024-01-15"
TARGET_MERGED_AT, SOURCE_MERGED_AT = "2024-01-21 00:00:00", "2024-02-01 00:00:00"


def upsert_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.upsert import upsert

    target = _silver_window(spark, sf_dir, TARGET_LAST_DAY, None, 0.0, TARGET_MERGED_AT)
    source = _silver_window(spark, sf_dir, None, SOURCE_FIRST_DAY, 1.0, SOURCE_MERGED_AT)
    return upsert(target, source, wx.WEATHER_KEYS)


def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.facts import WEATHER_FACT, build_fact

    customer = si.table(spark, sf_dir, "customer")
    return build_fact(WEATHER_FACT, dedup_latest(spark, sf_dir), si.dim_city_ids_v1(customer))


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact MERGE keeping surrogate keys. Keys depend on the row layout, so the
    target's are derived from its grain here, and the result says of each row
    whether it kept its key; pytest checks that fresh keys are unique."""
    from stratum.operators.facts import WEATHER_FACT as spec
    from stratum.operators.facts import build_fact, upsert_fact

    dim = si.dim_city_ids_v1(si.table(spark, sf_dir, "customer"))
    key = -F.abs(F.xxhash64(*spec.keys))  # below all fresh keys
    first = build_fact(spec, _silver_window(spark, sf_dir, TARGET_LAST_DAY, None, 0.0, TARGET_MERGED_AT), dim)
    target = first.withColumn(spec.sk, key).select(spec.sk, *spec.columns)
    source = build_fact(spec, _silver_window(spark, sf_dir, None, SOURCE_FIRST_DAY, 1.0, SOURCE_MERGED_AT), dim)
    merged = upsert_fact(target, source, spec.keys, spec.sk, sk_offset=0)
    return merged.withColumn("kept_key", F.col(spec.sk) == key).drop(spec.sk)


# ------------------------------------------------------------ SCD2

# Tracked attributes of the city dimension and its key.
CITY_TRACKED = ["population", "elevation_m", "timezone"]
CITY_SK = "city_sk"


def _city_snapshot(bronze: DataFrame) -> DataFrame:
    from stratum.operators.dedup import latest_run, one_per_key
    from stratum.operators.shaping import shape_city_attributes

    return one_per_key(shape_city_attributes(latest_run(bronze)), ["city_id"])


def _dim_after(spark: SparkSession, sf_dir: str, versions: int) -> DataFrame:
    """Dimension after the first snapshot, or after both (bronze holds both
    runs; the newest run is the snapshot applied)."""
    from stratum.operators.scd2 import empty_dim_like, scd2_apply

    customer = si.table(spark, sf_dir, "customer")
    bronze1 = si.bronze_city_snapshot(customer, 1)
    snap1 = _city_snapshot(bronze1)
    dim = scd2_apply(
        empty_dim_like(snap1, "city_id", CITY_SK, "timestamp_ntz"), snap1, "city_id", CITY_TRACKED,
        _ts(si.CITY_RUNS[1][1]), sk_col=CITY_SK, sk_offset=0,
    )
    if versions == 2:
        bronze_all = bronze1.unionByName(si.bronze_city_snapshot(customer, 2))
        dim = scd2_apply(dim, _city_snapshot(bronze_all), "city_id", CITY_TRACKED,
                         _ts(si.CITY_RUNS[2][1]), sk_col=CITY_SK, sk_offset=10**12)
    return dim


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.dedup import latest_run

    return latest_run(si.bronze_city_all(si.table(spark, sf_dir, "customer")))


def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.scd2 import current_rows, scd2_changes as changes

    customer = si.table(spark, sf_dir, "customer")
    current = current_rows(_dim_after(spark, sf_dir, 1))
    return changes(current, _city_snapshot(si.bronze_city_all(customer)), "city_id", CITY_TRACKED)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_after(spark, sf_dir, 2).drop(CITY_SK)


def dim_city_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.scd2 import current_rows

    return current_rows(_dim_after(spark, sf_dir, 2)).drop(CITY_SK)


# ------------------------------------------------------------ limits / sorts

def newest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 10 landed rows (top-k by ingest time)."""
    bronze = si.bronze_weather(si.table(spark, sf_dir, "events"))
    return bronze.orderBy(F.col("_ingested_at").desc()).limit(10).select(
        "_ingested_at", "city_id", "_source", "temperature_2m"
    )


def history_first_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 20 dimension versions by (city_id, effective_start_ts)."""
    return _dim_after(spark, sf_dir, 2).drop(CITY_SK).orderBy("city_id", "effective_start_ts").limit(20)


def mart_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(spark, sf_dir).orderBy(F.col("obs_date").desc(), F.col("city_name"))


# ------------------------------------------------------------ stations

def station_dq_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.plans.historical import split_station_daily

    _, invalid = split_station_daily(si.bronze_station_daily(si.table(spark, sf_dir, "events")))
    return invalid


def station_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.plans.historical import silver_station_daily, split_station_daily

    valid, _ = split_station_daily(si.bronze_station_daily(si.table(spark, sf_dir, "events")))
    return silver_station_daily(valid, _ts(MERGED_AT))


def station_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two backfills that arrive in the wrong order, each promoted by itself: what was
    landed in the afternoons is silver already when the mornings come."""
    from stratum.operators.upsert import upsert
    from stratum.plans.historical import STATION_KEYS, silver_station_daily, split_station_daily, with_station_bucket

    bronze = si.bronze_station_daily(si.table(spark, sf_dir, "events"))
    late, early = (with_station_bucket(silver_station_daily(split_station_daily(bronze.where(when))[0], _ts(MERGED_AT)))
                   for when in ("hour(_ingested_at) >= 12", "hour(_ingested_at) < 12"))
    return upsert(late, early, STATION_KEYS, newest_by="_ingested_at").drop("station_bucket")


# ------------------------------------------------------------ dims

def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.dims import date_dimension_for

    return date_dimension_for(si.table(spark, sf_dir, "events"), "ts")


# ------------------------------------------------------------ air quality

def nearest_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier location -> nearest city of the dimension (exact)."""
    from stratum.operators.nearest import nearest

    supplier, customer = _inputs(spark, sf_dir, "supplier", "customer")
    near = nearest(
        si.supplier_locations(supplier), si.cities_with_coordinates(customer),
        point_cols=("location_id", "latitude", "longitude"), ref_cols=("city_id", "latitude", "longitude"),
    )
    return near.select("location_id", "city_id")


def nearest_city_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept index of locations after a second version of the cities: some new,
    some gone, some moved, and a tenth of the locations new."""
    from stratum.operators.nearest import nearest, refresh

    supplier, customer = _inputs(spark, sf_dir, "supplier", "customer")
    names = {"point_cols": ("location_id", "latitude", "longitude"), "ref_cols": ("city_id", "latitude", "longitude")}
    first, second = si.cities_of_version(customer, 1), si.cities_of_version(customer, 2)
    known = nearest(si.supplier_locations(supplier.where("s_suppkey % 10 <> 0")), first, **names)
    return refresh(known, si.supplier_locations(supplier), first, second, **names).select("location_id", "city_id")


def _bronze_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.sources.air_quality_json import land_air_quality, parse_air_quality_lines

    events = si.table(spark, sf_dir, "events")
    return land_air_quality(parse_air_quality_lines(si.air_quality_lines(events)))


def land_air_quality_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze_air_quality(spark, sf_dir).drop("raw_json").withColumns(
        {
            "period_datetime_from": F.col("period_datetime_from").cast("timestamp_ntz"),
            "period_datetime_to": F.col("period_datetime_to").cast("timestamp_ntz"),
        }
    )


def _silver_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.plans.air_quality import silver_air_quality

    customer = si.table(spark, sf_dir, "customer")
    events = si.table(spark, sf_dir, "events")
    silver = silver_air_quality(si.bronze_air_quality(events), si.cities_with_coordinates(customer),
                                _ts(MERGED_AT))
    return silver.withColumn("observation_timestamp", F.col("observation_timestamp").cast("timestamp_ntz"))


def air_quality_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_air_quality(spark, sf_dir)


def air_quality_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.facts import AIR_QUALITY_FACT, build_fact

    customer = si.table(spark, sf_dir, "customer")
    return build_fact(AIR_QUALITY_FACT, _silver_air_quality(spark, sf_dir), si.dim_city_ids_v1(customer))


def _aqi_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.aqi import breakpoints, with_aqi

    return with_aqi(_silver_air_quality(spark, sf_dir), breakpoints(spark))


def aqi_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aqi_readings(spark, sf_dir).select(
        "location_id", "city_id", "parameter_name", "observation_timestamp", "value", "aqi", "aqi_category"
    )


def aqi_category_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.marts import dominant_category

    return dominant_category(_aqi_readings(spark, sf_dir))


def weather_aq_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.marts import daily_air_quality, weather_air_quality

    customer = si.table(spark, sf_dir, "customer")
    return weather_air_quality(
        dedup_latest(spark, sf_dir), daily_air_quality(_aqi_readings(spark, sf_dir), SCALE), si.dim_city_ids_v1(customer), SCALE
    )


def daily_summary_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart with its dominant AQI category filled in."""
    from stratum.operators.marts import dominant_category

    customer = si.table(spark, sf_dir, "customer")
    return daily_city_summary(dedup_latest(spark, sf_dir), si.dim_city_ids_v1(customer),
                              dominant_category=dominant_category(_aqi_readings(spark, sf_dir)), sum_scale=SCALE)


# ------------------------------------------------------------ health

def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.health import pipeline_health

    return pipeline_health(si.run_log_from_orders(si.table(spark, sf_dir, "orders")))


# ------------------------------------------------------------ semantics of the runs

def upsert_late_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver meets a second batch whose rows are older for even cities and newer
    for odd ones: the newer row of each key survives."""
    from stratum.operators.upsert import upsert

    target = dedup_latest(spark, sf_dir)
    return upsert(target, _late_batch(target), wx.WEATHER_KEYS, newest_by="_ingested_at")


def dq_every_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with missing keys, stale times, odd temperatures and unknown cities,
    many of them several at once: how often each list of reasons occurs."""
    events, customer = _inputs(spark, sf_dir, "events", "customer")
    bronze = si.bronze_weather(events, keep=["event_id"]).withColumns({
        "city_id": F.when(F.col("event_id") % 97 != 0, F.col("city_id")),
        "observation_time": F.when(F.col("event_id") % 89 != 0, F.col("observation_time"))})
    rules = wx.weather_rules("TIMESTAMP_NTZ '2024-01-31 00:00:00'")
    marked = rules.mark(wx.weather_candidates(bronze, si.dim_city_ids_v1(customer)))
    return marked.groupBy(rules.reasons().alias("failure_reason")).agg(
        F.count("*").alias("n"), F.min("city_id").alias("least_city"), F.max("temperature_c").alias("warmest"))


def aq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality readings with missing times, missing and negative values."""
    from stratum.plans.air_quality import AQ_KEYS, AQ_RULES, aq_candidates

    bronze = si.bronze_air_quality(si.table(spark, sf_dir, "events")).withColumns({
        "value": F.when(F.col("value") >= 0.5, F.col("value") - 2),
        "period_datetime_from": F.when(F.col("location_id") % 13 != 0, F.col("period_datetime_from"))})
    _, invalid = AQ_RULES.split(aq_candidates(bronze))
    rows = q.quarantine_records(invalid, "silver.air_quality_readings", AQ_KEYS, quarantined_at=_ts(QUARANTINED_AT))
    return rows.groupBy("source_table", "_ingestion_run_id", "failure_reason").agg(F.count("*").alias("n"))


# ------------------------------------------------------------ feeds, states, keys

def _upsert_merge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, merge of the second batch into it)."""
    from stratum.operators.upsert import merge

    target = _silver_window(spark, sf_dir, TARGET_LAST_DAY, None, 0.0, TARGET_MERGED_AT)
    source = _silver_window(spark, sf_dir, None, SOURCE_FIRST_DAY, 1.0, SOURCE_MERGED_AT)
    return target, merge(target, source, wx.WEATHER_KEYS)


def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of the upsert: what each changed row was and is."""
    from stratum.operators.upsert import changes

    _, merged = _upsert_merge(spark, sf_dir)
    return changes(merged, wx.WEATHER_KEYS).select(
        *wx.WEATHER_KEYS, F.when(F.col("before").isNull(), "insert").otherwise("update").alias("change"),
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ("temperature_c", "precipitation_mm", "_ingested_at", "_merged_at")])


def upsert_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old table brought forward by the feed: the upserted table."""
    from stratum.operators.upsert import apply_changes, changes

    target, merged = _upsert_merge(spark, sf_dir)
    return apply_changes(target, changes(merged, wx.WEATHER_KEYS), wx.WEATHER_KEYS)


def mart_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart read from states that follow the feed of the upsert: replaced
    rows are taken off, new ones added, days that lost an extreme aggregated anew."""
    from stratum.operators.marts import DAILY_WEATHER, daily_summary_of_states
    from stratum.operators.states import advanced, states_of
    from stratum.operators.upsert import changes, merged_rows

    target, merged = _upsert_merge(spark, sf_dir)
    states = advanced(states_of(target, DAILY_WEATHER), changes(merged, wx.WEATHER_KEYS), merged_rows(merged), DAILY_WEATHER)
    return daily_summary_of_states(states, si.dim_city_ids_v1(si.table(spark, sf_dir, "customer")))


def _late_batch(target: DataFrame) -> DataFrame:
    """Rows of ``target`` again: older for even cities, newer for odd ones, and every
    third city at other times."""
    hour = F.expr("INTERVAL 1 HOUR")
    shifted = F.when(F.col("city_id") % 2 == 0, F.col("_ingested_at") - hour).otherwise(F.col("_ingested_at") + hour)
    again = target.where("city_id % 3 <> 0").withColumns({"temperature_c": F.col("temperature_c") + 1, "_ingested_at": shifted})
    other = target.where("city_id % 3 = 0").withColumn("observation_timestamp", F.col("observation_timestamp") + F.expr("INTERVAL 400 DAYS"))
    return again.unionByName(other)


def mart_from_states_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a late run: rows that lose to newer ones leave no trace in the
    states."""
    from stratum.operators.marts import DAILY_WEATHER, daily_summary_of_states
    from stratum.operators.states import advanced, states_of
    from stratum.operators.upsert import changes, merge, merged_rows

    table = dedup_latest(spark, sf_dir)
    merged = merge(table, _late_batch(table), wx.WEATHER_KEYS, newest_by="_ingested_at")
    states = advanced(states_of(table, DAILY_WEATHER), changes(merged, wx.WEATHER_KEYS), merged_rows(merged), DAILY_WEATHER)
    return daily_summary_of_states(states, si.dim_city_ids_v1(si.table(spark, sf_dir, "customer")))


def fact_dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys without gaps: the first load, then an upsert above its mark."""
    from stratum.operators.facts import FACT_BUCKETS, WEATHER_FACT as spec
    from stratum.operators.facts import build_fact, upsert_fact_dense
    from stratum.operators.keys import max_key, number_rows

    dim = si.dim_city_ids_v1(si.table(spark, sf_dir, "customer"))
    first = build_fact(spec, _silver_window(spark, sf_dir, TARGET_LAST_DAY, None, 0.0, TARGET_MERGED_AT), dim)
    target = number_rows(first.withColumn(spec.sk, F.lit(None).cast("bigint")).select(spec.sk, *spec.columns), spec.sk, 0, FACT_BUCKETS, spec.keys)
    source = build_fact(spec, _silver_window(spark, sf_dir, None, SOURCE_FIRST_DAY, 1.0, SOURCE_MERGED_AT), dim)
    high = max_key(target, spec.sk)  # a run reads the kept mark instead
    return upsert_fact_dense(target, source, spec.keys, spec.sk, high).select(spec.sk, *spec.keys, "date_sk", "temperature_c")


def scd2_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots applied in one run, landed out of order."""
    from stratum.operators.scd2 import empty_dim_like, scd2_history
    from stratum.plans.dim_city import city_snapshots

    customer = si.table(spark, sf_dir, "customer")
    bronze = si.bronze_city_snapshot(customer, 2).unionByName(si.bronze_city_snapshot(customer, 3)).unionByName(si.bronze_city_snapshot(customer, 1))
    snapshots = city_snapshots(bronze)
    empty = empty_dim_like(snapshots.drop("_ingested_at"), "city_id", CITY_SK, "timestamp_ntz")
    return scd2_history(empty, snapshots, "city_id", CITY_TRACKED, "_ingested_at", CITY_SK).drop(CITY_SK)


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log holds of each landing run."""
    from stratum.plans.runlog import run_counts as counts

    return counts(_marked_weather(spark, sf_dir), "observation_timestamp")


def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows restored from their quarantine records, column by column."""
    invalid = dq_split_invalid(spark, sf_dir)
    records = q.quarantine_records(invalid, "silver.weather_observations", wx.WEATHER_KEYS, quarantined_at=_ts(QUARANTINED_AT))
    columns = ", ".join(f"{n} {t}" for n, t in invalid.drop("failure_reason").dtypes)
    return q.restore_records(records, columns)


def quarantine_repromoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose reason is gone, once all cities are known, pass the same rules;
    their latest rows are what silver receives."""
    customer = si.table(spark, sf_dir, "customer")
    restored = quarantine_replay(spark, sf_dir).drop("failure_reason", wx.KNOWN_CITY)
    every_city = customer.select(F.col("c_custkey").alias("city_id"))
    again = WEATHER_RULES.mark(wx.with_reference_flag(restored, "city_id", every_city, wx.KNOWN_CITY))
    return wx.silver_weather(WEATHER_RULES.passed(again).drop(wx.KNOWN_CITY), _ts(MERGED_AT))


def dq_gate_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on a batch that the gate does not admit."""
    from stratum.plans.historical import STATION_GATE_THRESHOLD, STATION_RULES

    return q.Gate(STATION_GATE_THRESHOLD).report(STATION_RULES.mark(_station_rows_with_gaps(spark, sf_dir)))


def _station_rows_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators.shaping import shape_station_daily

    bronze = si.bronze_station_daily(si.table(spark, sf_dir, "events"))
    tenth = F.abs(F.col("data_value")) % 10
    return shape_station_daily(bronze.withColumns({
        "station_id": F.when(tenth != 1, F.col("station_id")), "obs_date": F.when(tenth != 2, F.col("obs_date")),
        "data_value": F.when(F.abs(F.col("data_value")) % 100 != 33, F.col("data_value"))}))


def station_dq_every_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each list of reasons occurs among station cells that miss their
    station, day or value."""
    from stratum.plans.historical import STATION_RULES

    marked = STATION_RULES.mark(_station_rows_with_gaps(spark, sf_dir))
    return marked.groupBy(STATION_RULES.reasons().alias("failure_reason")).agg(F.count("*").alias("n"), F.max("value").alias("highest"))


def scope_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of named stations within a range of days; a station of the list that
    the files do not hold would be refused."""
    from stratum.sources.scope import check_stations, scope_dates
    from stratum.sources.scope import scope_stations as scoped

    bronze = si.bronze_station_daily(si.table(spark, sf_dir, "events"))
    chosen = [f"ST{n:09d}" for n in (0, 3, 7, 11, 14)]
    check_stations(spark, chosen, bronze)
    return scope_dates(scoped(bronze, chosen), "2024-01-05", None)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "land_weather_json": land_weather_json,
    "land_city_tsv": land_city_tsv,
    "unpack_station_month": unpack_station_month,
    "scope_date_range": scope_date_range,
    "shape_units": shape_units,
    "dq_split_valid": dq_split_valid,
    "dq_split_invalid": dq_split_invalid,
    "quarantine_records": quarantine_records,
    "dq_gate_rate": dq_gate_rate,
    "dedup_latest": dedup_latest,
    "daily_summary": daily_summary,
    "upsert_silver": upsert_silver,
    "fact_build": fact_build,
    "fact_upsert": fact_upsert,
    "latest_snapshot": latest_snapshot,
    "scd2_changes": scd2_changes,
    "scd2_apply": scd2_apply,
    "dim_city_current": dim_city_current,
    "newest_k": newest_k,
    "history_first_k": history_first_k,
    "mart_sorted": mart_sorted,
    "station_dq_invalid": station_dq_invalid,
    "station_dedup_latest": station_dedup_latest,
    "station_history_upsert": station_history_upsert,
    "dim_date": dim_date,
    "nearest_city": nearest_city,
    "nearest_city_kept": nearest_city_kept,
    "land_air_quality_json": land_air_quality_json,
    "air_quality_silver": air_quality_silver,
    "air_quality_fact": air_quality_fact,
    "aqi_readings": aqi_readings,
    "aqi_category_daily": aqi_category_daily,
    "weather_aq_mart": weather_aq_mart,
    "daily_summary_aqi": daily_summary_aqi,
    "run_health": run_health,
    "upsert_late_run": upsert_late_run,
    "dq_every_reason": dq_every_reason,
    "aq_quarantine": aq_quarantine,
    "upsert_changes": upsert_changes,
    "upsert_applied": upsert_applied,
    "mart_from_states": mart_from_states,
    "mart_from_states_late": mart_from_states_late,
    "fact_dense_keys": fact_dense_keys,
    "scd2_snapshots": scd2_snapshots,
    "run_counts": run_counts,
    "quarantine_replay": quarantine_replay,
    "quarantine_repromoted": quarantine_repromoted,
    "dq_gate_closed": dq_gate_closed,
    "station_dq_every_reason": station_dq_every_reason,
    "scope_stations": scope_stations,
}

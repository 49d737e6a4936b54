"""Session construction and the few session facts the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Day boundaries follow UTC (the source API is queried in UTC).
SESSION_TIME_ZONE = "UTC"


def build_session(
    master: str | None = None,
    app_name: str = "stratum",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings every job here assumes.

    ANSI mode stays on (Spark 4 default) so bad casts fail loudly; raw text is
    always parsed with ``try_*`` functions instead. AQE re-plans joins and
    coalesces shuffle partitions at runtime, and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_session(spark)
    ensure_checkpoint_dir(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Pin the runtime SQL settings results depend on (day boundaries)."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder would lose
    checkpoints with the executor that wrote them, so none is invented there.
    Only a local-mode session (tests, benches) without the setting gets a
    fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(e.g. the cluster's object store) before running stratum jobs"
        )
    folder = tempfile.mkdtemp(prefix="stratum-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for staged tables of one job."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

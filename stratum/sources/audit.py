"""Audit columns stamped on every landed row."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_audit(
    df: DataFrame,
    source: Column | None = None,
    run_id: Column | None = None,
    ingested_at: Column | None = None,
    default_source: str = "unknown",
) -> DataFrame:
    """Set ``_source``, ``_ingested_at``, ``_ingestion_run_id`` and the
    partition column ``_ingest_date`` (UTC day of ``_ingested_at``).

    An argument overrides; otherwise a column already on ``df`` is kept;
    otherwise the default applies (``default_source``, a fresh uuid, the
    query's ``current_timestamp()``). Plans pass literals captured once per
    run so every action over the run sees the same values.
    """
    def pick(name: str, given: Column | None, default: Column) -> Column:
        if given is not None:
            return given
        return F.col(name) if name in df.columns else default

    at = pick("_ingested_at", ingested_at, F.current_timestamp())
    audit = {
        "_source": pick("_source", source, F.lit(default_source)),
        "_ingested_at": at,
        "_ingestion_run_id": pick("_ingestion_run_id", run_id, F.lit(str(uuid.uuid4()))),
        "_ingest_date": F.to_date(at),
    }
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in audit],
                     *[v.alias(k) for k, v in audit.items()])

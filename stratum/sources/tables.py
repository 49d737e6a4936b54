"""Catalog tables on Parquet: creation, scans, appends, partition rewrites
and keyed upserts scoped to the partitions a batch touches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.operators.upsert import DuplicateSourceKeys, changes, merge, merged_rows, upsert
from stratum.schemas import DIM_CITY_CURRENT_COLUMNS, DIM_CITY_CURRENT_VIEW, TABLES, TableSpec
from stratum.session import shared_dir


def profile_source(source: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                   context: str = "upsert", check_unique: bool = True) -> tuple[int, list[tuple]]:
    """One aggregation over an upsert batch: number of rows, a duplicate
    matchable key (raises), and the partitions it touches.

    Partition values must be a function of the key (true for every table
    here): a key moving partition would need both partitions rewritten. The
    touched list is a ``collect_set`` of partition values, so its size is
    bounded by the partition count, never by the data.
    """
    matchable = F.lit(True)
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    part = F.struct(*[F.col(c) for c in partition_by]) if partition_by else F.lit(None)
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(matchable).alias("m"), F.min(part).alias("p")
    )
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.max(F.when(F.col("m") & (F.col("n") > 1), F.struct(*keys))).alias("dup"),
        F.collect_set("p").alias("parts"),
    ).first()
    if check_unique and row["dup"] is not None:
        raise DuplicateSourceKeys(f"{context}: several source rows match key {row['dup'].asDict()}")
    touched = [tuple(p) for p in row["parts"]] if partition_by else []
    return int(row["rows"]), touched


def partition_filter(partition_by: Sequence[str], touched: Sequence[tuple]) -> Column:
    """Exactly the touched partitions: for each value of the leading columns a
    list of the last one's, NULL values included. Static pruning at the scan."""
    by_lead: dict[tuple, list] = {}
    for t in touched:
        by_lead.setdefault(tuple(t[:-1]), []).append(t[-1])
    cond = F.lit(False)
    for lead, last in by_lead.items():
        one = F.lit(True)
        for c, v in zip(partition_by[:-1], lead, strict=True):
            one = one & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        values = sorted(v for v in last if v is not None)
        tail = F.col(partition_by[-1]).isin(values) if values else F.lit(False)
        if len(values) < len(last):
            tail = tail | F.col(partition_by[-1]).isNull()
        cond = cond | (one & tail)
    return cond


class Touched(list):
    """Partition values an upsert rewrote; ``rows``: rows of its source."""

    rows = 0


class Lakehouse:
    """The bronze / silver / gold (+ ops) schemas rooted at ``root``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def name(self, table: str) -> str:
        schema, t = table.split(".")
        return f"{self.prefix}{schema}.{t}"

    # ---------------------------------------------------------------- DDL
    def create(self) -> None:
        """Idempotent: schemas, all tables, the current-city view."""
        for schema in sorted({t.split(".")[0] for t in TABLES}):
            self.spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{schema} LOCATION '{self.root}/{schema}'"
            )
        for spec in TABLES.values():
            self._create_table(spec)
        cols = ", ".join(DIM_CITY_CURRENT_COLUMNS)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(DIM_CITY_CURRENT_VIEW)} AS "
            f"SELECT {cols} FROM {self.name('silver.dim_city')} WHERE is_current = true"
        )

    def _create_table(self, spec: TableSpec) -> None:
        part = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        schema, t = spec.name.split(".")
        if self.spark.catalog.tableExists(self.name(spec.name)):
            info = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(spec.name)}").collect()
            loc = next((r.data_type for r in info if r.col_name == "Location"), "")
            if loc.rstrip("/").removeprefix("file:") != f"{self.root}/{schema}/{t}".removeprefix("file:"):
                raise ValueError(f"{self.name(spec.name)} already exists at {loc}, not under {self.root}; "
                                 "use another prefix")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(spec.name)} ({spec.columns}) USING parquet"
            f"{part} LOCATION '{self.root}/{schema}/{t}'"
        )

    # ---------------------------------------------------------------- scans
    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def columns(self, table: str) -> list[str]:
        return self.table(table).columns

    # ---------------------------------------------------------------- writes
    def _shaped(self, df: DataFrame, table: str) -> DataFrame:
        """Table column order (partition columns last); partitioned writes
        are rebalanced on the partition columns so AQE splits a hot partition
        across tasks and merges tiny ones (balanced files, no skewed task)."""
        out = df.select(*self.columns(table))
        parts = TABLES[table].partition_by if table in TABLES else ()
        return out.hint("rebalance", *parts) if parts else out

    def append(self, df: DataFrame, table: str) -> int:
        """Append in table column order (partition columns last); returns the rows
        written, counted by the write itself. A landing (bronze) is entered in the
        register: its runs and days, in the same pass. Rows without a run id get one
        of their own landing, so that every landing can be told."""
        landing = table.startswith("bronze.")
        if landing:
            df = df.withColumn("_ingestion_run_id", F.coalesce("_ingestion_run_id", F.lit(f"landing-{uuid.uuid4().hex}")))
        shaped = self._shaped(df, table)
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows")]
        if landing:  # one entry a run and day
            counted.append(F.collect_set(F.struct("_ingestion_run_id", "_ingest_date")).alias("runs"))
        shaped.observe(seen, *counted).write.insertInto(self.name(table), overwrite=False)
        self.refresh(table)
        got = seen.get
        if landing and got["runs"]:
            rows = got["rows"] if len(got["runs"]) == 1 else None
            entries = [(table, r["_ingestion_run_id"], r["_ingest_date"], rows) for r in got["runs"]]
            self.append(self.spark.createDataFrame(entries, "source_table string, run_id string, ingest_date date, row_count bigint").withColumn(
                "landed_at", F.current_timestamp()).coalesce(1), "ops.landing_log")
        return int(got["rows"])

    def refresh(self, table: str) -> None:
        """Drop this session's cached file listing of ``table``: a write made
        through another session (e.g. a stream's micro-batch) would
        otherwise stay invisible here."""
        self.spark.catalog.refreshTable(self.name(table))

    def overwrite_partitions(self, df: DataFrame, table: str) -> None:
        """Replace exactly the partitions present in ``df`` (dynamic mode);
        an unpartitioned table is replaced whole. ``df`` must not read the
        table itself: stage it first (see :meth:`upsert`)."""
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        self._shaped(df, table).write.insertInto(self.name(table), overwrite=True)
        self.refresh(table)

    @contextmanager
    def staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` as Parquet in the shared checkpoint folder for the time of the
        block: cuts lineage, so the result may replace tables it was made from,
        and survives executor loss. The files go when the block ends well; after
        a failure they stay, as the copy to recover from."""
        path = shared_dir(self.spark, f"stage/{uuid.uuid4().hex}")
        df.write.parquet(path)
        yield self.spark.read.schema(df.schema).parquet(path)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def upsert(self, source: DataFrame, table: str, keys: Sequence[str] | None = None,
               check_unique: bool = True, newest_by: str | None = None,
               before_write: Callable[[list], None] | None = None,
               on_changes: Callable[[DataFrame, list], None] | None = None) -> Touched:
        """Keyed upsert of ``source`` into ``table``.

        Only partitions that ``source`` touches are read and rewritten: their
        values (a list bounded by the partition count, not the data) pick the
        partitions to scan, the merged result is staged, then written with
        dynamic partition overwrite. Not atomic across partitions. ``newest_by``:
        see :func:`stratum.operators.upsert.upsert`. Returns the touched values.

        ``on_changes`` receives the change feed (keys, before, after) and the touched
        values when the table is written; ``before_write`` the touched values before.
        The feed comes from the merge itself and is read from its staged result.
        """
        spec = TABLES[table]
        keys = list(keys or spec.keys)
        # The batch feeds the profile and the merge: keep it (batch-sized,
        # spills to disk) so its upstream — dedup window, joins — runs once. Its
        # measured size also lets Spark decide about broadcasting its keys.
        source = source.select(*self.columns(table)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, touched = profile_source(source, keys, spec.partition_by, context=table, check_unique=check_unique)
            result = Touched(touched)
            result.rows = rows
            target = self.table(table)
            if spec.partition_by:
                if not touched:
                    return result
                target = target.filter(partition_filter(spec.partition_by, touched))
            if before_write:
                before_write(touched)
            if on_changes is None:
                with self.staged(upsert(target, source, keys, newest_by)) as merged:
                    self.overwrite_partitions(merged, table)
            else:
                both = merge(target, source, keys, newest_by)
                same = F.col("before").eqNullSafe(F.col("after"))
                small = both.select(F.when(~same, F.col("before")).alias("before"), "after", (~same).alias("changed"))
                with self.staged(small) as merged:
                    self.overwrite_partitions(merged_rows(merged), table)
                    on_changes(changes(merged.where("changed"), keys), touched)
        finally:
            source.unpersist()
        return result

    def replace(self, df: DataFrame, table: str) -> None:
        """Rewrite a whole (small, unpartitioned) table from a plan that may
        read it: staged first."""
        with self.staged(df.select(*self.columns(table))) as staged:
            self.overwrite_partitions(staged, table)

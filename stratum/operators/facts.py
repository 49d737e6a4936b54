"""Star-schema facts: one builder for every fact, driven by its contract, and a
keyed upsert that keeps surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import date_sk
from stratum.operators.keys import assign_new_keys, carry_keys, max_key, number_rows
from stratum.operators.references import only_referenced
from stratum.operators.shaping import conform, contract_columns
from stratum.operators.upsert import upsert


@dataclass(frozen=True)
class FactSpec:
    """A fact table: grain and attributes come from the table's contract."""

    table: str
    sk: str

    @property
    def keys(self) -> list[str]:
        from stratum.schemas import TABLES

        return list(TABLES[self.table].keys)

    @property
    def columns(self) -> list[str]:
        return contract_columns(self.table, without=(self.sk,))


WEATHER_FACT = FactSpec("gold.fact_weather_observation", "weather_observation_sk")
AIR_QUALITY_FACT = FactSpec("gold.fact_air_quality_reading", "air_quality_reading_sk")


def build_fact(spec: FactSpec, silver: DataFrame, dim_city: DataFrame) -> DataFrame:
    """The fact's rows (without surrogate key) from silver. A semi join keeps
    the readings whose city the dimension has; it neither doubles rows nor
    needs distinct ids."""
    known = only_referenced(silver, "city_id", dim_city)
    return conform(known, spec.columns, derived={"date_sk": date_sk("observation_timestamp")})


def upsert_fact(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    sk_col: str,
    sk_offset: int | None = None,
) -> DataFrame:
    """MERGE with explicit columns: matched rows take the source's non-key
    values but keep their surrogate key; new rows get fresh keys above the
    current maximum. ``sk_offset`` skips the max scan when known."""
    offset = max_key(target, sk_col) if sk_offset is None else sk_offset
    staged = assign_new_keys(carry_keys(target, source, keys, sk_col), sk_col, offset)
    return upsert(target, staged.select(*target.columns), keys)


#: Buckets in which new facts are numbered: a day's cities, dealt by number.
FACT_BUCKETS = ("date_sk", "pmod(city_id, 256)")


def upsert_fact_dense(target: DataFrame, source: DataFrame, keys: Sequence[str], sk_col: str, high: int) -> DataFrame:
    """As :func:`upsert_fact`, but new rows are numbered without gaps from
    ``high`` + 1 on, in the order of day, city bucket and key."""
    carried = carry_keys(target, source, keys, sk_col)
    new = carried.where(F.col(sk_col).isNull()).select(*target.columns)
    kept = carried.where(F.col(sk_col).isNotNull()).select(*target.columns)
    return upsert(target, kept.unionByName(number_rows(new, sk_col, high, FACT_BUCKETS, keys)), keys)


def with_new_keys(df: DataFrame, sk_col: str, offset: int = 0) -> DataFrame:
    """First load: every row gets a fresh key, placed first."""
    return assign_new_keys(df.withColumn(sk_col, F.lit(None).cast("bigint")), sk_col, offset).select(
        sk_col, *df.columns
    )

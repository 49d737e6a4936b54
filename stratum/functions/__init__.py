"""Column-level helpers built only from ``pyspark.sql.functions``."""

from stratum.functions.columns import (
    date_sk,
    exact_avg,
    exact_sum,
    natural_key,
    record_json,
)
from stratum.functions.geo import EARTH_RADIUS_KM, haversine_km

__all__ = [
    "EARTH_RADIUS_KM",
    "date_sk",
    "exact_avg",
    "exact_sum",
    "haversine_km",
    "natural_key",
    "record_json",
]

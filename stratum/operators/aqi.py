"""Air-quality index and category from a breakpoint table.

The concentration is truncated to the table's precision for its pollutant,
the breakpoint row containing it is found with a range condition on a
broadcast equi-join on the pollutant (the table is a fixed, small list), and
the index is interpolated linearly within the row and rounded to an integer.
The last band of a pollutant is open: concentrations beyond it keep its category
and its highest index, so the worst air is never left out. Readings are first
brought to the table's unit. Negative concentrations, unknown pollutants and
units without a factor have no index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# US EPA AQI breakpoints (public; PM2.5 per the 2024 revision).
# (parameter, decimals kept when truncating, c_low, c_high, i_low, i_high, category, severity)
EPA_BREAKPOINTS = [
    ("pm25", 1, 0.0, 9.0, 0, 50, "Good", 1),
    ("pm25", 1, 9.1, 35.4, 51, 100, "Moderate", 2),
    ("pm25", 1, 35.5, 55.4, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("pm25", 1, 55.5, 125.4, 151, 200, "Unhealthy", 4),
    ("pm25", 1, 125.5, 225.4, 201, 300, "Very Unhealthy", 5),
    ("pm25", 1, 225.5, 325.4, 301, 500, "Hazardous", 6),
    ("pm10", 0, 0.0, 54.0, 0, 50, "Good", 1),
    ("pm10", 0, 55.0, 154.0, 51, 100, "Moderate", 2),
    ("pm10", 0, 155.0, 254.0, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("pm10", 0, 255.0, 354.0, 151, 200, "Unhealthy", 4),
    ("pm10", 0, 355.0, 424.0, 201, 300, "Very Unhealthy", 5),
    ("pm10", 0, 425.0, 604.0, 301, 500, "Hazardous", 6),
    ("o3", 3, 0.000, 0.054, 0, 50, "Good", 1),
    ("o3", 3, 0.055, 0.070, 51, 100, "Moderate", 2),
    ("o3", 3, 0.071, 0.085, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("o3", 3, 0.086, 0.105, 151, 200, "Unhealthy", 4),
    ("o3", 3, 0.106, 0.200, 201, 300, "Very Unhealthy", 5),
    # Beyond 0.200 ppm the public table goes on with the 1-hour bands.
    ("o3", 3, 0.201, 0.404, 300, 300, "Very Unhealthy", 5),
    ("o3", 3, 0.405, 0.504, 301, 400, "Hazardous", 6),
    ("o3", 3, 0.505, 0.604, 401, 500, "Hazardous", 6),
    ("no2", 0, 0.0, 53.0, 0, 50, "Good", 1),
    ("no2", 0, 54.0, 100.0, 51, 100, "Moderate", 2),
    ("no2", 0, 101.0, 360.0, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("no2", 0, 361.0, 649.0, 151, 200, "Unhealthy", 4),
    ("no2", 0, 650.0, 1249.0, 201, 300, "Very Unhealthy", 5),
    ("no2", 0, 1250.0, 2049.0, 301, 500, "Hazardous", 6),
    ("so2", 0, 0.0, 35.0, 0, 50, "Good", 1),
    ("so2", 0, 36.0, 75.0, 51, 100, "Moderate", 2),
    ("so2", 0, 76.0, 185.0, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("so2", 0, 186.0, 304.0, 151, 200, "Unhealthy", 4),
    ("so2", 0, 305.0, 604.0, 201, 300, "Very Unhealthy", 5),
    ("so2", 0, 605.0, 1004.0, 301, 500, "Hazardous", 6),
    ("co", 1, 0.0, 4.4, 0, 50, "Good", 1),
    ("co", 1, 4.5, 9.4, 51, 100, "Moderate", 2),
    ("co", 1, 9.5, 12.4, 101, 150, "Unhealthy for Sensitive Groups", 3),
    ("co", 1, 12.5, 15.4, 151, 200, "Unhealthy", 4),
    ("co", 1, 15.5, 30.4, 201, 300, "Very Unhealthy", 5),
    ("co", 1, 30.5, 50.4, 301, 500, "Hazardous", 6),
]

# Fixed values: (parameter, unit) -> factor to the table's unit (µg/m³ for
# particles, ppm for o3 and co, ppb for no2 and so2; gases at 25 °C, 1 atm).
UNIT_FACTORS = {
    ("pm25", "µg/m³"): 1.0, ("pm10", "µg/m³"): 1.0,
    ("o3", "ppm"): 1.0, ("o3", "ppb"): 0.001, ("o3", "µg/m³"): 1 / 1962.0,
    ("no2", "ppb"): 1.0, ("no2", "ppm"): 1000.0, ("no2", "µg/m³"): 1 / 1.881,
    ("so2", "ppb"): 1.0, ("so2", "ppm"): 1000.0, ("so2", "µg/m³"): 1 / 2.62,
    ("co", "ppm"): 1.0, ("co", "ppb"): 0.001, ("co", "µg/m³"): 1 / 1145.0,
}

BREAKPOINT_SCHEMA = (
    "parameter_name string, decimals int, c_low double, c_high double, "
    "i_low int, i_high int, category string, severity int"
)


def breakpoints(spark: SparkSession, rows=EPA_BREAKPOINTS) -> DataFrame:
    return spark.createDataFrame(list(rows), BREAKPOINT_SCHEMA)


def _in_table_unit(value_col: str, unit_col: str | None) -> Column:
    value = F.col(f"r.{value_col}")
    if unit_col is None:
        return value
    factors = F.create_map(*[F.lit(x) for (p, u), f in UNIT_FACTORS.items() for x in (f"{p} {u}", f)])
    named = F.concat_ws(" ", F.col("r.parameter_name"), F.col(f"r.{unit_col}"))
    return value * F.try_element_at(factors, named)


def with_aqi(readings: DataFrame, table: DataFrame, value_col: str = "value",
             unit_col: str | None = "parameter_units") -> DataFrame:
    """Add ``aqi`` (int), ``aqi_category`` and ``aqi_severity`` per reading.

    The breakpoint table is broadcast: its size is fixed by the number of
    pollutants and bands, independent of the data. Without a ``unit_col`` values
    are taken to be in the table's unit.
    """
    unit_col = unit_col if unit_col in readings.columns else None
    last = table.withColumn("last", F.col("c_low") == F.max("c_low").over(Window.partitionBy("parameter_name")))
    scale = F.pow(F.lit(10.0), F.col("bp.decimals"))
    truncated = F.floor(_in_table_unit(value_col, unit_col) * scale) / scale
    cond = (
        (F.col("r.parameter_name") == F.col("bp.parameter_name"))
        & (truncated >= F.col("bp.c_low"))
        & ((truncated <= F.col("bp.c_high")) | F.col("bp.last"))
    )
    joined = readings.alias("r").join(F.broadcast(last.alias("bp")), cond, "left")
    index = (F.col("bp.i_high") - F.col("bp.i_low")) / (F.col("bp.c_high") - F.col("bp.c_low")) * (
        F.least(truncated, F.col("bp.c_high")) - F.col("bp.c_low")
    ) + F.col("bp.i_low")
    return joined.select(
        "r.*",
        F.round(index).cast("int").alias("aqi"),
        F.col("bp.category").alias("aqi_category"),
        F.col("bp.severity").alias("aqi_severity"),
    )

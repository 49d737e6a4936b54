"""What is derived from what, and catching up on owed days along these edges.

A table that changes owes its changed days to the tables derived from it. Catching
up goes through the derived tables in the order of the graph: each takes the days
it is owed, and owes them on to those that read it. So whatever broke off a run,
a closed gate, a crash, a step that was never called, is made good by the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from stratum.plans import gold, runlog

SILVER_WEATHER, SILVER_AIR_QUALITY = "silver.weather_observations", "silver.air_quality_readings"


@dataclass(frozen=True)
class Derived:
    """A table, what it is made of, and the run that brings days of it up to date."""

    name: str
    inputs: tuple[str, ...]
    run: Callable[..., int]


TABLES = {d.name: d for d in (
    Derived("daily_state", (SILVER_WEATHER,), lambda lake, days: gold.rebuild_states(lake, days)),
    Derived("weather_fact", (SILVER_WEATHER,), lambda lake, days: gold.run_weather_fact(lake, days)),
    Derived("air_quality_fact", (SILVER_AIR_QUALITY,), lambda lake, days: gold.run_air_quality_fact(lake, days)),
    Derived("daily_mart", ("daily_state", SILVER_AIR_QUALITY), lambda lake, days: gold.run_daily_mart(lake, days)),
    Derived("weather_aq_mart", ("daily_state", SILVER_AIR_QUALITY), lambda lake, days: gold.run_weather_aq_mart(lake, days)),
)}


def order() -> list[str]:
    """The derived tables, each after what it reads."""
    return [n for n in TopologicalSorter({d.name: d.inputs for d in TABLES.values()}).static_order() if n in TABLES]


def readers(table: str) -> list[str]:
    return [d.name for d in TABLES.values() if table in d.inputs]


def owe(lake, table: str, days: Sequence[dt.date]) -> None:
    """``table`` has changed on ``days``: its readers have to process them."""
    runlog.owe(lake, readers(table), days)


def catch_up(lake) -> dict[str, int]:
    """Bring every derived table up to date; partitions written, by table."""
    done = dict.fromkeys(TABLES, 0)
    for name in order():
        days = runlog.owed_days(lake, name)
        if days:
            done[name] = TABLES[name].run(lake, days)
            owe(lake, name, days)
    return {**done, "mart_partitions": done["daily_mart"], "fact_partitions": done["weather_fact"]}

"""stratum: medallion-style observation analytics as Spark jobs.

Layers: ``sources`` land raw text (JSON, TSV, fixed width) into bronze frames,
``operators`` hold the table-level transforms (quality checks, latest-wins
dedup, keyed upsert, SCD2, facts, marts), ``plans`` wire them into the
bronze -> silver -> gold runs, ``streaming`` drives the same runs
incrementally over newly landed files.
"""

__version__ = "0.1.0"

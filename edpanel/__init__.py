"""edpanel: a Spark-native engine for monthly emergency-department activity panels.

Layout
------
- ``session``      Spark session defaults (UTC, ANSI, AQE) and the shared checkpoint folder.
- ``sources``      table scans, raw-file hashing, exported grids, web-page links, the schema registry.
- ``functions``    Column-returning helpers (safe percentage, financial year, row hash, coercions).
- ``operators``    DataFrame -> DataFrame building blocks: grid shaping, drift, change detection,
                   sinks, dimensions, KPIs, analytics, data quality.
- ``plans``        composed plans: the analogue star over the driver tables, marts, the query catalog.
- ``streaming``    incremental, idempotent file ingest with Structured Streaming.
"""

__all__ = ["session"]

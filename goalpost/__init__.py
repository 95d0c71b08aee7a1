"""goalpost: Spark-native indicator / target-tracking pipeline.

Layers: ``sources`` (layered Parquet I/O, ingest registry), ``functions``
(Column expressions), ``operators`` (DataFrame -> DataFrame building blocks:
quality rules, lookups, rollups, ranking), ``plans`` (the Silver / Gold /
analysis / dashboard jobs) and ``streaming`` (validated event ingestion).
Everything is plain DataFrame code; domain column names are parameters.
"""

__version__ = "0.1.0"

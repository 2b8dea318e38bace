"""chainyard: a supply-chain warehouse built on Spark DataFrames.

Layers: ``sources`` (ingestion with lineage and read-back validation),
``plans`` (staging, snapshots, dimensions, facts), ``operators``
(point-in-time join, SCD2 snapshot, keyed merge, data quality),
``functions`` (column expressions), ``streaming`` (file-triggered
incremental ingestion).
"""

__version__ = "0.1.0"

"""bikelake — Spark-native lakehouse analytics for shared-mobility data.

Layout:
  sources/    readers: parquet tables, JSON/CSV file streams, schema contracts, dimensions
  functions/  Column -> Column cleaners (ids, names, categories, casts, time)
  operators/  DataFrame -> DataFrame operators (latest-per-key, joins, gold models,
              ranking, profiling, data quality)
  sinks/      publish, keyed upsert over versioned parquet, partitioned landing
  streaming/  incremental ingest (availableNow) and incremental current state
  plans/      the live / historical flows and the query catalogue bound to the test tables
"""

__version__ = "0.1.0"

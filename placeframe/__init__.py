"""placeframe: Spark-native analytics tables about places and their conditions.

Layout:
  functions/  Column -> Column helpers (array means, ladders, safe casts, codes)
  operators/  DataFrame -> DataFrame operators (clean, join, aggregate, quality)
  sources/    readers (typed NDJSON, nested NDJSON, hive parquet, pages, manifests)
  sinks/      writers (partitioned parquet, dated NDJSON, published zones, tables)
  plans/      composed jobs (enrichment job, marts) and the query registry

"""

__version__ = "0.1.0"

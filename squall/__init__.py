"""squall: sliding-window wind KPIs and forecast-point queries on Spark.

Layout
------
``sources``    record sources (stream and batch), location dimension, landed documents
``functions``  column expressions: record parsing, event time, line rendering
``operators``  DataFrame operators: KPIs, array flattening, enrichment, upsert, store, limits
``streaming``  Structured Streaming jobs and their foreachBatch sinks
``plans``      the registered queries over the test tables and their SQL oracles
"""

__version__ = "0.1.0"

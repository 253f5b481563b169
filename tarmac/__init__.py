"""tarmac — Spark-native punctuality / operations analytics.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column ->
Column``) built from the public PySpark DataFrame / SQL / ML / Structured
Streaming API, so Catalyst plans it and Tungsten runs it.

Layout
------
``sources``    scans, sinks, page extraction, run-log documents
``functions``  scalar column functions and the small p-value helpers
``operators``  joins, aggregates, windows, rank statistics, sampling, upsert,
               resampling
``plans``      the named result sets (views), experiments and the query
               registry used by ``__spark_entry__.py``
``streaming``  Structured Streaming versions of ingest / upsert / trend / dedup
"""

__version__ = "0.1.0"

"""tollgate — Spark-native medallion trip analytics and experiment analytics.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame primitives so Catalyst can prune, push down and
partially aggregate.  Sub-packages:

* ``sources``   scans, table management, file layout, artifacts
* ``functions`` scalar Column helpers (time, size parsing, hashing, JSON)
* ``operators`` normalization, marts, quality rules, metric analytics, stats
* ``plans``     composite jobs and the query registry
* ``streaming`` incremental month ingest on Structured Streaming
"""

__version__ = "0.1.0"

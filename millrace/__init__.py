"""millrace: predictive-maintenance analytics as plain Spark DataFrame / SQL /
Structured Streaming / pyspark.ml jobs.

Sub-packages
------------
sources    table/stream readers and writers, fixture views over the test tables
functions  scalar column helpers (time, coin, lookup, casts)
operators  DataFrame -> DataFrame operators (windows, aggregates, profiles,
           features, joins, models)
plans      end-to-end pipelines (OEE, anomaly, device, engine) and the named
           query registry used by ``__spark_entry__``
streaming  the same pipelines expressed as Structured Streaming queries
"""

__version__ = "0.1.0"

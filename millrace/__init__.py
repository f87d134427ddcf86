"""millrace: a library of Spark-native analytics jobs.

Every job is a function from DataFrames to a DataFrame.  The packages are

* ``sources`` / ``sinks``   readers and writers, batch and streaming
* ``functions``             column expressions (bands, time, geo, pricing rules, UDFs)
* ``operators``             joins, aggregates, ordered windows, quality rules, layout
* ``plans``                 complete jobs: billing, logs, visits, trips, warehouse, forecast
* ``streaming``             Structured Streaming jobs and their batch twins
* ``queries``               the named queries and the SQL each one must agree with
"""

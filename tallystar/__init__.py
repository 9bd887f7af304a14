"""Event-to-star-schema jobs on Spark.

``functions``  Column builders (coercion, timestamps, keys)
``operators``  DataFrame -> DataFrame transformations
``sources``    tables, CSV snapshots, stream sources
``streaming``  Structured Streaming jobs
``plans``      whole runs: bootstrap, silver run, user-star run
"""

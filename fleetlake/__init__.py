"""Spark-native analytics for vehicle-telemetry lakes.

Subpackages:

- ``functions``  column expressions (time grid, geography, object paths)
- ``operators``  DataFrame -> DataFrame building blocks (trips, edges, grids)
- ``sources``    lake reader/writers, object listings, configs, triggers
- ``plans``      whole jobs (trip summary, event table, custom messages, backlog)
- ``streaming``  Structured Streaming forms of the same jobs
- ``suite``      the registered queries and their SQL oracles
"""

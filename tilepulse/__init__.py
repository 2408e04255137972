"""tilepulse: daily engagement reporting for UI tiles, written on the Spark DataFrame / SQL API.

Layers:
  sources/    table registry (schemas, DDL), catalog scans, shaping of the driver's test tables
  functions/  reusable Column expressions (day predicate, guarded ratio, zero fill)
  operators/  per-tile distinct-user metrics, enrichment, KPIs, data-quality checks
  plans/      the daily job, its range form, and the registered queries
  streaming/  Structured Streaming trigger that re-runs the dates touched by new events
  sinks, evolve  partition-replacing writes and schema evolution / rollback
"""

__version__ = "0.1.0"

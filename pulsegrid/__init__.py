"""pulsegrid: daily-activity analytics (DAU, quality, hourly CCU) as Spark DataFrame jobs.

Layout:
  functions/  column expressions (blank tests, timestamp parsing, predicates)
  sources/    readers, sinks and the mapping of the shared fixture tables
  operators/  DataFrame -> DataFrame building blocks (quality, fact, metrics, cubes, CCU, tables)
  plans/      end-to-end jobs, the registered query catalog and its SQL oracle
  streaming/  Structured Streaming forms of the fact, hourly CCU and DAU flows
"""

from pulsegrid.schemas import DQ_REASONS, FACT_COLUMNS, FACT_KEYS

__all__ = ["DQ_REASONS", "FACT_COLUMNS", "FACT_KEYS"]

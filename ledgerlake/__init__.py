"""ledgerlake: payments and fraud analytics written as Spark DataFrame jobs.

Sub-packages:
  sources/    readers with declared schemas, test-table fixtures, file metadata
  sinks/      overwrite / append / partitioned / view / topic-routing writers
  functions/  Column-building helpers (casts, CASE maps, masks, hashes, checks)
  operators/  DataFrame -> DataFrame operators (silver, gold, metrics, fraud, PCI ...)
  plans/      composed jobs (medallion refresh, increments, batch API) + query registry
  streaming/  Structured Streaming jobs (validation, DLQ, join, dedupe, state)
"""

__version__ = "0.1.0"

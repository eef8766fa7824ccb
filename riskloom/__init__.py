"""riskloom: daily credit-risk panels as Spark DataFrame plans.

Sub-packages:
  functions/  column-expression builders (clean, dates, rating, booleans)
  operators/  DataFrame -> DataFrame operators (filters, joins, windows,
              aggregates, reshape, table mutation, quality checks)
  sources/    file listing, matrix / CSV / JSON / registry scans, sinks
  plans/      jobs and derived serving tables composed from the operators,
              plus the query catalogue used by ``__spark_entry__``
  streaming/  incremental file ingest with Structured Streaming
"""

__all__ = ["session", "schemas", "fixtures"]

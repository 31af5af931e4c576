"""tidepool: social-post and stream analytics expressed as Spark DataFrame / SQL / Structured Streaming plans.

Layout
  sources/    driver tables, canonical views, bronze ingest, sinks, warehouse tables
  functions/  column-level building blocks (masking, binning, tokenising, hashing)
  operators/  DataFrame -> DataFrame operators (silver, gold, quality, ranking, search, ...)
  plans/      named SQL views, the query registry and its DuckDB oracle text
  streaming/  Structured Streaming jobs (running aggregates, windows, alerts, reports)
"""

__version__ = "0.1.0"

"""feedlens: product analytics for a feed + messenger app, written as Spark jobs.

Subpackages:
  sources    readers for the two action tables, schema checks, sinks
  functions  column expressions (dates, ratios, hashes, text) and p-value UDFs
  operators  the analytics: reports, cohorts, ETL slices, experiments, alerts
  plans      named queries built from the operators, plus scheduled jobs
  streaming  the 15-minute alert as a Structured Streaming query
"""

__version__ = "0.1.0"

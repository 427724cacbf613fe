"""Spark-native quality estimation for machine-made speech transcripts.

Layout:
  functions/  column expressions (text, WER, acoustics, confidence)
  sources/    batch and streaming readers
  sinks/      writers (feature history, manifest, lookup, models)
  operators/  DataFrame -> DataFrame operators (validation, features, stats, monitoring, models)
  plans/      composed jobs a user calls (extract, train, validate, deploy, score, monitor)
  streaming/  Structured Streaming forms of ingest, scoring and monitoring
"""

__version__ = "0.1.0"

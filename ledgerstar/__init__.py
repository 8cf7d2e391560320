"""Spark-native profiling, gated ingest, star modelling and reporting for tabular extracts."""

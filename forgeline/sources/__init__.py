"""Readers of the lake and of source files (spark.read only)."""

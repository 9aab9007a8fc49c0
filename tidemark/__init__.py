"""Changelog-to-index engine and training-data operators on Spark."""

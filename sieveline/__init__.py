"""Spark-native engine for incremental document triage."""

__version__ = "0.1.0"

"""Spark-native history and health analytics over database telemetry snapshots."""

__version__ = "0.1.0"

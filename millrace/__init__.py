"""Spark-native analytics over device telemetry and customer records."""

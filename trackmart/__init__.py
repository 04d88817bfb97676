"""Trackmart: aircraft-telemetry analytics as Spark DataFrame operators."""

"""Sensor-reading analytics written as plain Spark DataFrame functions."""

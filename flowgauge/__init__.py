"""Spark batch and streaming operators for sensor, payment and database events."""

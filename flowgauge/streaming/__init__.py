"""Streaming jobs, sinks, keyed tables and stateful operators."""

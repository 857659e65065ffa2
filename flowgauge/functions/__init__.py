"""Column functions: time units, text, distance, and named functions."""

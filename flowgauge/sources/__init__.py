"""Schemas, readers, record decoding and the table catalogue."""

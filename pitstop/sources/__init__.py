"""Schemas, readers and sinks."""

"""Batch and stream sources with declared schemas, and stream sinks."""

"""Scans and sinks: driver tables, fixture views, file and model I/O."""

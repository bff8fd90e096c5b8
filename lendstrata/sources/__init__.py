"""Readers, schemas and sinks."""

"""Batch jobs that chain sources, operators and sinks."""

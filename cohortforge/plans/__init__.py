"""Pipelines (feature assembly, model dataset) and the query registry."""

"""Readers, sinks and the test-table adapters."""

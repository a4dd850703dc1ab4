"""Readers, sinks and the mapping of the shared fixture tables."""

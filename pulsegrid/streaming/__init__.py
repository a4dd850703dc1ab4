"""Structured Streaming forms of the fact, hourly CCU and DAU flows."""

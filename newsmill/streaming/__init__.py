"""Structured Streaming forms of the queries that make sense on a live feed."""

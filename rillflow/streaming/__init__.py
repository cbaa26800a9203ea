"""Structured Streaming runs of the ingest and publish plans."""

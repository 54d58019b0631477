"""Streaming form of the ingest run."""

"""Composed plans: one frame to long rows, and a whole ingest run."""

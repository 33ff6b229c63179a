"""Structured Streaming jobs: landed files through the same operators as the batch jobs."""

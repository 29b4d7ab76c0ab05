"""Structured Streaming: file ingest, admission and progress."""

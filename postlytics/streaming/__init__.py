"""Structured Streaming jobs: ingest, acceptance and scoring, and the minute view."""

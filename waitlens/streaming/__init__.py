"""Structured Streaming ingestion and event-window monitoring."""

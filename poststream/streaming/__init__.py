"""Structured Streaming: sources, enrichment, dedup, keyed upsert log, trends."""

"""Structured Streaming forms of bars, keyed upserts and dedupe (STR-1..3)."""

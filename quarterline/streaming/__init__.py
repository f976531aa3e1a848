"""Structured Streaming forms of ingest and candle building."""

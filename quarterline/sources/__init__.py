"""Scans and sinks: raw CSV ingest, panel tables, candle builders, JSON reports."""

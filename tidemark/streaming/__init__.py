"""Structured Streaming jobs: telemetry ingestion, billing change capture, live KPIs."""

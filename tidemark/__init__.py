"""Streaming lakehouse analytics for network telemetry and billing data, on PySpark."""

__version__ = "0.1.0"

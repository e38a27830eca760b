"""Telemetry and order analytics expressed as Spark DataFrame, SQL and Structured Streaming jobs."""

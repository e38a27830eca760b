"""Relational operators over telemetry and order data."""

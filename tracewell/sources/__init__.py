"""Inputs: telemetry requests, orders, the product catalog, rates and ads."""

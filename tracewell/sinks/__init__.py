"""Outputs: maintained tables and the order feed."""

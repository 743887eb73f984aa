"""Aggregates, reports and the analytics suite on top of the layers."""

"""Pipelines and published aggregates."""

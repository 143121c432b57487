"""Relational operators shared by the pipelines."""

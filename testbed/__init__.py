"""Inputs for the registered queries, derived from the given tables, and their check SQL."""

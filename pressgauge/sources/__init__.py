"""Landed payloads and tables, read into typed DataFrames.

Nothing here fetches over the network: payloads are tables a collector wrote.
"""

"""Structured Streaming jobs.

All run with ``trigger(availableNow=True)`` by default and write directories keyed
by query and batch, so a replayed micro-batch rewrites exactly its own rows and a
new checkpoint touches none of another's. Keyed state lies in RocksDB.
"""

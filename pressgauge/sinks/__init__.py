"""Writers. Every write is safe to repeat."""

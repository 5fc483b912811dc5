"""Reusable DataFrame operators: deduplication, merge, top-k, gates, state."""

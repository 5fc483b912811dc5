"""Snapshot files, raw listings, and tables."""

"""Compaction that continues where the last run stopped."""

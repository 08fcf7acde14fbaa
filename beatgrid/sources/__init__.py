"""Readers, validators, compaction and sinks."""

"""Sinks: layer tables and their upkeep."""

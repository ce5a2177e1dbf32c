"""Incremental upkeep of the current state."""

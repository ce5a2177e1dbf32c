"""Incremental extraction, raw landing, file loading and exports."""

"""Lot-level event analytics as PySpark DataFrame operators."""

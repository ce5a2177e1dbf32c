"""Models built from the operators, reports on them, and the registered queries."""

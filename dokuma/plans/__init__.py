"""Composite dataflows and the query catalogue."""

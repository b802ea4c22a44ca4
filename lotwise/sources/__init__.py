"""Scans of the nested and flat feeds, sinks and the state tables."""

"""Procurement market and signal analytics expressed as Spark DataFrames."""

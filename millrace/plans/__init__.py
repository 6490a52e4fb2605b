"""Whole jobs. Each takes DataFrames in the source system's columns."""

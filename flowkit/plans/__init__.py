"""Whole jobs, from their inputs to their outputs."""

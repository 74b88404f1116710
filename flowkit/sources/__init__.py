"""Readers for files, tables, value lists and message streams."""

"""Scans of text lines, delimited files and parquet datasets, and the source registry."""

"""Whole runs: the batch from raw files to reports, and the catalog of named queries."""

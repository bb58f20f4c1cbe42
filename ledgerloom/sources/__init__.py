"""Batch files, typed loads and run outputs."""

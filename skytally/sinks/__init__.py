"""Stored tables: their layout, and how batches and versions are written."""

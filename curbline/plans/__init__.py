"""Stored tables, their mergeable state, incremental loads and the batch run."""

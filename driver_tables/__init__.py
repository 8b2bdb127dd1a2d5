"""Trips derived from the shared test tables, for the query registry and the bench."""

"""Reading and writing trips, tables and results."""

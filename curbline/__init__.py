"""Point-to-point trip analytics as Spark DataFrame operators.

Every operator takes a DataFrame (trips, or a stored aggregate table) and
returns a DataFrame; nothing is collected unless a docstring says so.
"""

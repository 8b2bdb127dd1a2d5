"""Names for columns that an operator adds for itself."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``docs`` has no column of it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str, side: str = "") -> str:
    """A column name as SQL reads it, whatever it holds; of the side of a join."""
    return (f"{side}." if side else "") + "`" + name.replace("`", "``") + "`"

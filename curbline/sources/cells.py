"""Cells of text into typed columns: what a strict parse loses, and how much of it is repaired.

A column is read as text and goes through a chain of readings; the first that
understands a cell gives its value. The first link is the plain form of the type, the
others are forms that exports of other tools leave behind. A cell that no link reads
is rejected: it becomes NULL and its row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from curbline import schema as S

#: A dollar amount, or a number with marks between its thousands.
MARKED_NUMBER = r"^([+-]?)\$?([+-]?)(\d{1,3}(?:,\d{3})+|\d+)(\.\d+)?$"
#: Month first, with a 24-hour or a 12-hour clock.
OTHER_TIMES = ("M/d/yyyy H:mm[:ss]", "M/d/yyyy h:mm[:ss] a")


def as_text(schema: StructType = S.TRIP_SCHEMA) -> StructType:
    """The same columns, none of them parsed."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def _whole(cell: Column) -> Column:
    """``1.0`` or ``1e0`` as an integer; a number with a fraction is none."""
    number = cell.try_cast("double")
    return F.when(number == F.floor(number), number).try_cast("int")


def _marked(cell: Column) -> Column:
    bare = F.regexp_replace(cell, r"[$,]", "")
    return F.when(F.rlike(cell, F.lit(MARKED_NUMBER)), bare).try_cast("double")


def links(name: str, kind: DataType) -> list[Column]:
    """Readings of a text column, the plain one first."""
    cell = F.trim(F.col(name))
    if isinstance(kind, IntegerType):
        return [cell.try_cast("int"), _whole(cell)]
    if isinstance(kind, DoubleType):
        return [cell.try_cast("double"), _marked(cell)]
    if isinstance(kind, TimestampType):
        # without a date a cast would take today's
        plain = F.when(F.substring(cell, 5, 1) == "-", cell).try_cast("timestamp")
        return [plain, *[F.try_to_timestamp(F.upper(cell), F.lit(form)) for form in OTHER_TIMES]]
    return [F.col(name)]


def _empty(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def typed(texts: DataFrame, schema: StructType = S.TRIP_SCHEMA) -> DataFrame:
    """Typed columns from text columns of the same names; other columns stay."""
    read = {f.name: F.coalesce(*links(f.name, f.dataType)) for f in schema.fields}
    return texts.select(*[read[c].alias(c) if c in read else F.col(c) for c in texts.columns])


def cell_report(texts: DataFrame, schema: StructType = S.TRIP_SCHEMA) -> DataFrame:
    """One row a column: cells, and how many were empty, repaired and rejected.

    Empty: no text, blanks, or a row that ends early. All columns are counted in one
    pass; an empty table gives zeros.
    """
    counts, shown = [], []
    for i, f in enumerate(schema.fields):
        readings = links(f.name, f.dataType)
        filled = ~_empty(f.name)
        odd = filled & readings[0].isNull()
        lost = filled & F.coalesce(*readings).isNull()
        counts += [F.count_if(~filled).alias(f"e{i}"), F.count_if(odd).alias(f"o{i}"), F.count_if(lost).alias(f"l{i}")]
        shown.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("n").alias("cells"),
                F.col(f"e{i}").alias("empty"),
                (F.col(f"o{i}") - F.col(f"l{i}")).alias("repaired"),
                F.col(f"l{i}").alias("rejected"),
            )
        )
    return texts.agg(F.count(F.lit(1)).alias("n"), *counts).select(F.inline(F.array(*shown)))

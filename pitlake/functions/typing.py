"""Landed text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the landed text form of every date.
LANDED_DATE = "yyyyMMdd"


def date_text(column: Column) -> Column:
    """Trimmed text, blank as NULL."""
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def typed(field: T.StructField) -> Column:
    """Strict: a malformed date or number fails the job."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        return F.to_date(date_text(column), LANDED_DATE).alias(field.name)
    return column.cast(field.dataType).alias(field.name)


def tried(field: T.StructField) -> Column:
    """Lenient: a malformed date or number becomes NULL."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        stamp = F.try_to_timestamp(date_text(column), F.lit(LANDED_DATE))
        return stamp.cast("date").alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def malformed(field: T.StructField) -> Column:
    """True where there is text but it does not have the declared type."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.lit(False)
    present = date_text(column) if isinstance(field.dataType, T.DateType) else column
    return present.isNotNull() & tried(field).isNull()

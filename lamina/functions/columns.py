"""Keys, numbers and predicates of invoice lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.schemas import WORKING_DECIMAL

# Fixed values.
MISSING_DESCRIPTION = "SIN_DESCRIPCION"
CANCELLATION_PREFIX = "C"
KEY_SEPARATOR = "_"


def natural_key(invoice: str = "INVOICENO", product: str = "STOCKCODE") -> Column:
    """Invoice and product in one text key; NULL when either is NULL."""
    return F.concat(F.col(invoice).cast("string"), F.lit(KEY_SEPARATOR), F.col(product).cast("string"))


def to_working_decimal(c: Column) -> Column:
    """decimal(10,2), NULL for text that is no number and for values that do not fit."""
    return c.try_cast(WORKING_DECIMAL)


def is_cancellation() -> Column:
    """Three-valued: NULL for a ``C`` invoice without a quantity, so neither side keeps it."""
    return (F.col("QUANTITY") < 0) & F.col("INVOICENO").startswith(CANCELLATION_PREFIX)

"""Declared constraints checked as data jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.incremental import without_match

REASON = "REJECT_REASON"


def reject_reason(required: Sequence[str]) -> Column:
    """The required columns that are NULL, as text; NULL for a row that may be stored."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in required])
    return F.when(missing != "", missing)


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet NOT NULL, and the others with the columns they miss."""
    accepted = df.dropna(subset=list(required)) if required else df
    rejected = df.withColumn(REASON, reject_reason(required)).filter(F.col(REASON).isNotNull())
    return accepted, rejected


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values on more than one row, with their number of rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias("REPEATS")).filter(F.col("REPEATS") > 1)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose foreign key has no parent; a NULL foreign key refers to nothing."""
    return without_match(child.filter(F.col(foreign_key).isNotNull()), [foreign_key], parent, [key])


def not_leased(df: DataFrame, id_col: str, first: int, after: int) -> DataFrame:
    """Rows whose id is NULL or not one of ``first`` to ``after`` - 1."""
    own = (F.col(id_col) >= F.lit(first)) & (F.col(id_col) < F.lit(after))
    return df.filter(~F.coalesce(own, F.lit(False)))

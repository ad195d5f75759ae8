"""Row and NULL counts of a load, taken while the load itself runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


def profile_metrics(df: DataFrame) -> list[Column]:
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns]
    return [F.count("*").alias(ROWS), *nulls]


def observed(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, Observation]:
    """``df`` with its profile attached: the next action on it fills the observation."""
    observation = Observation(name)
    return df.observe(observation, *profile_metrics(df), *more), observation


def profile_frame(df: DataFrame, observation: Observation) -> DataFrame:
    """The observed numbers, one row per column."""
    counts = observation.get
    rows = [(c, counts[ROWS], counts[f"nulls_{c}"]) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, row_count bigint, null_count bigint")

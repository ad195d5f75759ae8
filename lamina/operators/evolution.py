"""Differences between an incoming frame and its target table, and how to bridge them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names a text-typed warehouse uses for Spark types.
WAREHOUSE_TYPES = {
    T.StringType: "STRING",
    T.IntegerType: "NUMBER",
    T.FloatType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.DecimalType: "NUMBER",
}
OTHER_WAREHOUSE_TYPE = "STRING"


def warehouse_type(data_type: T.DataType) -> str:
    return WAREHOUSE_TYPES.get(type(data_type), OTHER_WAREHOUSE_TYPE)


def new_columns(incoming: T.StructType, target: T.StructType) -> list[T.StructField]:
    """Incoming columns the target does not have; names compare without case."""
    known = {name.upper() for name in target.names}
    return [f for f in incoming if f.name.upper() not in known]


def schema_diff(incoming: DataFrame, target: T.StructType) -> DataFrame:
    """New columns of ``incoming`` with both type names and their number of filled rows."""
    added = new_columns(incoming.schema, target)
    if not added:
        return incoming.sparkSession.createDataFrame(
            [], "column_name string, spark_type string, warehouse_type string, filled bigint"
        )
    filled = incoming.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in added])
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("spark_type"),
            F.lit(warehouse_type(f.dataType)).alias("warehouse_type"),
            F.col(f"`{f.name}`").alias("filled"),
        )
        for f in added
    ]
    return filled.select(F.inline(F.array(*entries)))


#: Values of a row that do not fit their column's type, as the text they arrived as.
RESCUED = "RESCUED_VALUES"
RESCUED_TYPE = T.MapType(T.StringType(), T.StringType())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns, types and order of ``schema``; columns it lacks become NULL.

    Numbers that do not fit their declared type become NULL; decimals round half up. If the
    schema has a column ``RESCUED_VALUES``, what a cast would lose is kept there by name.
    """
    have = {name.upper(): name for name in df.columns}
    rescued = rescued_values(df, schema)
    columns = []
    for f in schema:
        name = have.get(f.name.upper())
        if f.name == RESCUED and name is None:
            columns.append(rescued.alias(RESCUED))
        elif name is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[name].dataType == f.dataType:
            columns.append(F.col(f"`{name}`").alias(f.name))
        else:
            columns.append(F.col(f"`{name}`").try_cast(f.dataType).alias(f.name))
    return df.select(*columns)


def lossy_columns(incoming: T.StructType, target: T.StructType) -> list[tuple[str, T.StructField]]:
    """(incoming name, target field) of the columns whose type differs."""
    stored = {f.name.upper(): f for f in target}
    pairs = [(f.name, f.dataType, stored.get(f.name.upper())) for f in incoming]
    return [(name, field) for name, kind, field in pairs if field is not None and field.dataType != kind]


def rescued_values(df: DataFrame, schema: T.StructType) -> Column:
    """Target column to arriving text for the values that a cast to ``schema`` loses; NULL if there are none.

    A value fits if the cast and back gives it again, or, for text, the same number.
    """
    entries = []
    for name, field in lossy_columns(df.schema, schema):
        value = F.col(f"`{name}`")
        typed, text = value.try_cast(field.dataType), value.cast("string")
        fits = typed.cast("string") == text
        if isinstance(field.dataType, T.NumericType):
            fits = fits | (typed.cast("double") == value.try_cast("double"))
        lost = value.isNotNull() & ~F.coalesce(fits, F.lit(False))
        entries.append(F.when(lost, F.struct(F.lit(field.name).alias("key"), text.alias("value"))))
    if not entries:
        return F.lit(None).cast(RESCUED_TYPE)
    kept = F.array_compact(F.array(*entries))
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def with_rescued(df: DataFrame) -> DataFrame:
    """Columns that have rescued values as the text that arrived, the other values as text of theirs."""
    if RESCUED not in df.columns:
        return df
    own = {c: F.coalesce(F.col(RESCUED)[c], F.col(f"`{c}`").cast("string")) for c in df.columns if c != RESCUED}
    return df.withColumns(own).drop(RESCUED)

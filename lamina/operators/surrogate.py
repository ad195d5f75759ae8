"""Surrogate ids that do not collide between loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import materialize

_POSITION, _SLOT, _PART, _OFFSET = "_position", "_slot", "_part", "_offset"

# Layout of monotonically_increasing_id: partition number above 33 bits of row number.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1

# More partitions than a Spark stage can usefully have.
PARTITION_STRIDE = 1 << 20


def next_id(stored: DataFrame, id_col: str) -> int:
    """First unused id: one aggregate over one column, one row to the driver."""
    top = stored.agg(F.max(id_col).alias("top")).first()["top"]
    return 0 if top is None else top + 1


def last_id(id_col: str | None) -> Column:
    """The largest id of the rows an append writes, to be observed by it; NULL for a table without ids."""
    return F.max(id_col) if id_col else F.lit(None).cast("long")


def keyed_ids(
    df: DataFrame, id_col: str, parts: int, start: int = 0, by: Sequence[str] | None = None, once: bool = False
) -> DataFrame:
    """Unique ids from ``start`` on that follow from the rows: the same distinct rows get the same ids.

    Rows are dealt to ``parts`` tasks by ``by`` (default: all their columns) and sorted there; an
    id is the row's place times ``parts`` plus the part. One shuffle of the rows, no pass over
    older ones. With ``once`` repeated rows, which the same task gets, are one row.
    """
    by = list(by or df.columns)
    dealt = df.repartition(parts, *by)
    placed = (dealt.distinct() if once else dealt).sortWithinPartitions(*df.columns)
    part = F.pmod(F.hash(*by), F.lit(parts)).cast("long")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    numbered = placed.withColumns({_PART: part, _POSITION: place})
    return numbered.withColumn(id_col, F.lit(start).cast("long") + F.col(_POSITION) * parts + F.col(_PART)).drop(
        _PART, _POSITION
    )


def sparse_ids(df: DataFrame, id_col: str, start: int = 0) -> DataFrame:
    """Unique ids from ``start`` on, with gaps. Narrow: no shuffle, no extra pass.

    Row number times stride plus partition number, so a load uses up id space by
    its longest partition and not by its number of partitions. Number the rows
    last, right before they are written: a task that runs again may number its
    rows in another order, which only its own committed output shows then.
    """
    position = F.monotonically_increasing_id()
    part = F.shiftright(F.col(_POSITION), _ROW_BITS)
    row = F.col(_POSITION).bitwiseAND(F.lit(_ROW_MASK))
    checked = F.when(part < PARTITION_STRIDE, part).otherwise(
        F.raise_error(F.lit(f"sparse_ids needs fewer than {PARTITION_STRIDE} partitions"))
    )
    return (
        df.withColumn(_POSITION, position)
        .withColumn(id_col, F.lit(start).cast("long") + row * F.lit(PARTITION_STRIDE).cast("long") + checked)
        .drop(_POSITION)
    )


def dense_ids(
    df: DataFrame,
    id_col: str,
    order_by: Sequence[str] | None = None,
    start: int = 0,
    rows_stored: bool = False,
) -> DataFrame:
    """Consecutive ids from ``start`` on, in the order of ``order_by`` (default: all columns).

    Equals ``start - 1 + row_number()`` over the whole table without putting it
    into one task: range partitions are sorted on their own, and each one is
    shifted by the rows before it. The position in the scan breaks ties, so
    copies of one row spread over several range partitions.

    The rows are written before they are ranged, because ranging reads them twice
    (once for a sample) and positions have to be the same when a task is run
    again. ``rows_stored`` says that ``df`` is a narrow view of stored rows, or that no
    two of its rows tie, which saves this step. They are written again when sorted, because counting and
    shifting have to see the same partitions.
    """
    order = list(order_by or df.columns)
    ordered = (
        (df if rows_stored else materialize(df, "unnumbered", "zstd"))
        .withColumn(_POSITION, F.monotonically_increasing_id())
        .repartitionByRange(*order, _POSITION)
        .sortWithinPartitions(*order, _POSITION)
        .drop(_POSITION)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS))
    )
    stored = materialize(ordered, "dense-ids", "zstd")
    # One row per range partition: bounded by spark.sql.shuffle.partitions, not by the data.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(_PART)
        .agg(F.count("*").alias("_rows"))
        .select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_OFFSET))
    )
    row = F.col(_SLOT).bitwiseAND(F.lit(_ROW_MASK))
    return (
        stored.join(F.broadcast(offsets), _PART)
        .withColumn(id_col, F.lit(start).cast("long") + F.col(_OFFSET) + row)
        .drop(_PART, _SLOT, _OFFSET)
    )

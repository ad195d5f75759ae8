"""Recurring load: every trigger takes the CSV files that arrived since the last one."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lamina.operators.star import KEY
from lamina.plans.layers import run_increment
from lamina.schemas import INVOICE
from lamina.session import discard, exists
from lamina.sources.csv_files import declared_names, header_schema, read_csv_by_header, with_header
from lamina.sources.tables import Warehouse, no_rows

INTERVAL = "60 seconds"
#: What Spark lists of files; their content is not asked for.
FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving_lines(spark: SparkSession, folder: str, schema: T.StructType = INVOICE.schema) -> DataFrame:
    """The files of ``folder`` by the names in their header, as it is when the query starts.

    A file that arrives with another header fails the query; started again, or on a folder
    of that delivery, it takes the new columns. A trigger takes all files that are there:
    lines of one invoice in two files must not fall into two triggers, where the second
    would find the invoice stored.
    """
    return declared_names(with_header(spark.readStream, header_schema(spark, folder, schema)).csv(folder), schema)


def start_incremental_load(
    wh: Warehouse,
    lines: DataFrame,
    checkpoint: str,
    load_ts: datetime | None = None,
    grain: str = KEY,
    once: bool = False,
) -> StreamingQuery:
    """Push each micro-batch through all layers.

    A batch is written to a folder for as long as it is worked on, and all layers work on
    this copy: each table drops the keys it knows. Loads are named by stream and batch, so a
    batch that is repeated after a failure is taken by every table once, from the same copy, and
    gets the same ids. ``checkpoint`` is a folder all executors share. ``once`` takes what is there and stops.
    """
    return _started(wh, lines, lambda batch: batch, checkpoint, load_ts, grain, once)


def start_folder_load(
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    load_ts: datetime | None = None,
    grain: str = KEY,
    once: bool = False,
    schema: T.StructType = INVOICE.schema,
) -> StreamingQuery:
    """``start_incremental_load`` for a folder whose files may have any header.

    The stream says which files have arrived; each trigger reads them by their own headers, so a
    delivery with new columns neither fails the query nor needs a restart.
    """
    arrived = wh.spark.readStream.format("binaryFile").schema(FILES).load(folder).select("_metadata.file_path")

    def lines(batch: DataFrame) -> DataFrame:
        files = [row.file_path for row in batch.collect()]  # one row per arrived file, nothing of which is read
        return read_csv_by_header(wh.spark, files, schema) if files else no_rows(wh.spark, schema)

    return _started(wh, arrived, lines, checkpoint, load_ts, grain, once)


def _started(
    wh: Warehouse,
    arriving: DataFrame,
    lines: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    load_ts: datetime | None,
    grain: str,
    once: bool,
) -> StreamingQuery:
    stream = zlib.crc32(checkpoint.encode())

    def process(batch: DataFrame, batch_id: int) -> None:
        bronze = _staged(wh.spark, lines(batch), f"{checkpoint}/staged", batch_id)
        run_increment(wh, bronze, load_ts, grain, f"stream-{stream:08x}-{batch_id}")
        discard(wh.spark, f"{checkpoint}/staged/{batch_id}")

    trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
    return (
        arriving.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{checkpoint}/offsets")
        .trigger(**trigger)
        .start()
    )


def _staged(spark: SparkSession, found: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """The rows of a batch as a copy in ``folder``, the only one there.

    A batch that is repeated after a failure has the same files, so its copy is taken as it is
    where it was finished and has the same columns.
    """
    path = f"{folder}/{batch_id}"
    if not exists(spark, f"{path}/_SUCCESS") or spark.read.parquet(path).schema.simpleString() != found.schema.simpleString():
        discard(spark, folder)
        found.write.parquet(path, compression="zstd")
    return spark.read.schema(found.schema).parquet(path)

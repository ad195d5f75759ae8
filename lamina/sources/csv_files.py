"""Folders of CSV files with a header line, read by the names in it."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.schemas import INVOICE


def header_schema(spark: SparkSession, folder: str, declared: T.StructType) -> T.StructType:
    """The columns of a file's header in their order: known names (without case) in their
    declared type, others as text. Only one header line is read; without a file, ``declared``.
    """
    try:
        names = spark.read.option("header", True).csv(folder).columns
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return declared
    return typed_names(names, declared)


def typed_names(names: Sequence[str], declared: T.StructType) -> T.StructType:
    types = {f.name.upper(): f.dataType for f in declared}
    return T.StructType([T.StructField(n, types.get(n.upper(), T.StringType())) for n in names])


#: Files whose first lines are read at once.
OPENED = 8


def header_groups(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``paths`` by the names in their header; empty files are left out.

    The driver lists the files and reads the first line of each, through the file systems and
    codecs that Spark reads them with; no other line is read.
    """
    files = sorted(spark.read.text(paths).inputFiles())
    with ThreadPoolExecutor(OPENED) as pool:
        headers = list(pool.map(partial(_first_line, spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header is not None:
            names = tuple(next(csv.reader([header.removeprefix("\ufeff")]), ()))
            groups.setdefault(names, []).append(file)
    return groups


def _first_line(jvm, conf, file: str) -> str | None:
    """The first line of a file given by its address; None when it is empty."""
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        line = jvm.org.apache.hadoop.io.Text()
        found = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream, conf)
        return line.toString() if found.readLine(line) else None
    finally:
        stream.close()


def read_csv_by_header(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = INVOICE.schema
) -> DataFrame:
    """All CSV files below ``paths``, whose headers may differ: one typed read per header, united by name.

    Declared columns come first and are there in any case; the others follow as text, in the order
    of their names. A column that a file does not have is NULL in its lines. No file gives no lines.
    """
    found = {names: files for names, files in header_groups(spark, paths).items() if names}
    reads = [
        declared_names(with_header(spark.read, typed_names(names, schema)).csv(files), schema)
        for names, files in found.items()
    ]
    declared = spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reads, declared)
    return united.select(*schema.names, *sorted(c for c in united.columns if c not in schema.names))


def declared_names(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` with known columns spelled as declared."""
    spelled = {name.upper(): name for name in declared.names}
    return df.toDF(*[spelled.get(c.upper(), c) for c in df.columns])


def read_csv_folder(spark: SparkSession, folder: str, schema: T.StructType | None = INVOICE.schema) -> DataFrame:
    """All CSV files of ``folder``, which share one header.

    With a schema there is one pass: columns are found by name, whatever their order,
    unknown ones arrive as text, and a value that does not fit becomes NULL. A file
    whose header differs from the others' raises. ``schema=None`` infers the types,
    which reads everything once more.
    """
    if schema is None:
        return with_header(spark.read, None).csv(folder)
    return declared_names(with_header(spark.read, header_schema(spark, folder, schema)).csv(folder), schema)


def with_header(reader, schema: T.StructType | None):
    """Options shared by batch and stream readers. A file has to have the header that ``schema`` names."""
    reader = reader.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True)
    return reader.schema(schema).option("enforceSchema", False)


def write_csv_folder(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """A gzip file per task, which readers tell by its name; a little larger for half the time."""
    fast = df.write.option("header", True).option("zlib.compress.level", "BEST_SPEED")
    fast.mode(mode).csv(folder, compression="gzip")

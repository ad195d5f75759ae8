"""Layer tables in the Spark catalog, and tables behind any other connector."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.evolution import RESCUED, RESCUED_TYPE, conform, lossy_columns, new_columns
from lamina.operators.profiling import observed
from lamina.operators.quality import reject_reason
from lamina.operators.surrogate import last_id
from lamina.schemas import LOAD_DATE, Table
from lamina.session import temporary
from lamina.sources.ledger import KEY, KeyLedger, key_of

LAYERS = ("bronze", "silver", "gold")
#: Rows of one key that may go to one task; where a key has more, loads use joins that split it.
HOT_ROWS = 1_000


def is_empty(df: DataFrame) -> bool:
    """A job that stops at the first row."""
    return df.isEmpty()


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so a join against it costs no shuffle."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).filter(F.lit(False))


def scan_connector(
    spark: SparkSession, fmt: str, options: dict[str, str], table: str | None = None
) -> DataFrame:
    """A table behind any Spark data source, for example a JDBC or warehouse connector."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if table is None else reader.option("dbtable", table)).load()


def append_connector(df: DataFrame, fmt: str, options: dict[str, str], table: str | None = None) -> None:
    writer = df.write.format(fmt).options(**options).mode("append")
    (writer if table is None else writer.option("dbtable", table)).save()


@dataclass(frozen=True)
class Load:
    """What one append did: rows offered, rows rejected by NOT NULL, NULLs per column, rows with rescued values."""

    table: str
    offered: int
    rejected: int
    nulls: dict[str, int]
    next_id: int | None = None
    rescued: int = 0

    @property
    def stored(self) -> int:
        return self.offered - self.rejected


class Warehouse:
    """One catalog database per layer, all under one folder that executors share.

    ``load_keys`` names other columns than the declared load key for some tables, for example
    invoice and product, so that late lines of a known invoice are taken. ``buckets`` is the
    number of buckets of new key ledgers (default: the session's shuffle partitions).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "retail",
        fmt: str = "parquet",
        load_keys: Mapping[str, Sequence[str]] | None = None,
        buckets: int | None = None,
    ):
        self.spark, self.root, self.prefix, self.fmt = spark, root.rstrip("/"), prefix, fmt
        self.load_keys, self.buckets = dict(load_keys or {}), buckets
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{self.root}/{layer}'")

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, table: Table) -> str:
        return f"{self.database(table.layer)}.{table.name}"

    def key(self, table: Table) -> Column:
        """The load key as text."""
        return key_of(self.load_keys.get(table.name, [table.load_key]))

    def ledger(self, table: Table) -> KeyLedger:
        return KeyLedger(self.spark, self.name(table), self.buckets)

    def exists(self, table: Table) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self, table: Table, schema: T.StructType | None = None) -> None:
        """Create the table unless it exists, with its declared columns or the given ones."""
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in (schema or table.schema)
        )
        partitions = f"PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
        options = "OPTIONS (compression 'zstd')" if self.fmt == "parquet" else ""
        number = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = f"CLUSTERED BY ({table.bucket_by}) INTO {number} BUCKETS" if table.bucket_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING {self.fmt} {options} {partitions} {dealt}"
        )

    def scan(self, table: Table) -> DataFrame:
        """Stored rows; no rows of the declared columns while the table is missing."""
        if not self.exists(table):
            return no_rows(self.spark, table.schema)
        stored = self.spark.table(self.name(table))
        declared = [c for c in table.schema.names if c in stored.columns]
        return stored.select(*declared, *[c for c in stored.columns if c not in declared])

    def schema(self, table: Table) -> T.StructType:
        return self.scan(table).schema

    def add_columns(self, table: Table, fields: list[T.StructField]) -> None:
        if fields:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")

    def append(
        self, table: Table, df: DataFrame, load_ts: datetime | None = None, evolve: bool = False
    ) -> Load:
        """Append the rows that meet NOT NULL; count offered and rejected rows in the same job.

        A missing table is created first. With ``evolve`` unknown columns are added to it, and
        values that do not fit a stored column's type are kept as text in a column of their own
        (and counted), so nothing that arrives is lost. ``load_ts``, when
        all rows carry it, names the one partition that is written; without it
        Spark sorts the rows by partition first.
        """
        stored = self.schema(table)
        fresh = new_columns(df.schema, stored) if evolve else []
        if evolve and RESCUED not in stored.names and lossy_columns(df.schema, stored):
            fresh.append(T.StructField(RESCUED, RESCUED_TYPE))
        if not self.exists(table):
            self.create(table, T.StructType([*table.schema, *fresh]))
        else:
            self.add_columns(table, fresh)
        known = self.schema(table)
        rows = conform(df, T.StructType([*known, *new_columns(T.StructType(fresh), known)]))
        rescued = F.col(RESCUED).isNotNull() if RESCUED in rows.columns else F.lit(False)
        rejected = reject_reason(table.required).isNotNull()
        counted, observation = observed(
            rows, f"load {table.name}", F.count_if(rejected).alias("rejected"), last_id(table.primary_key).alias("last_id"), F.count_if(rescued).alias("rescued"),
        )
        self._insert(table, counted.filter(~rejected), load_ts)
        metrics = observation.get
        return Load(
            table=table.name,
            offered=metrics["rows"],
            rejected=metrics["rejected"],
            nulls={c: metrics[f"nulls_{c}"] for c in rows.columns},
            next_id=metrics["last_id"] + 1 if metrics["last_id"] is not None else None,
            rescued=metrics["rescued"],
        )

    def _insert(self, table: Table, rows: DataFrame, load_ts: datetime | None) -> None:
        partition = ""
        if table.partition_by and load_ts is not None:
            rows = rows.drop(LOAD_DATE)
            partition = f"PARTITION ({LOAD_DATE} = DATE'{load_ts.date()}')"
        self.spark.sql(f"INSERT INTO {self.name(table)} {partition} BY NAME SELECT * FROM {{rows}}", rows=rows)

    def append_unseen(
        self,
        table: Table,
        incoming: DataFrame,
        load_ts: datetime | None = None,
        load: str | None = None,
        evolve: bool = False,
        bounds: tuple[str | None, str | None] = (None, None),
        prepare: Callable[[DataFrame, int, int], DataFrame] | None = None,
        drops: bool = False,
        prepare_dealt: Callable[[DataFrame, int, int], DataFrame] | None = None,
    ) -> Load:
        """Append the rows whose load key no finished load brought, all rows of a key together.

        The unseen keys are written first, then the rows that have them, then the load's row in
        the ledger; a load that is cut short in between is settled by the next one. A load that
        is finished under the name ``load`` is not run again. ``bounds`` are the smallest and
        largest key of ``incoming``, where they are known: loads out of reach are not read.

        ``prepare`` gets the unseen rows, the first free id and the ledger's number of buckets (which
        stays as it is for good), and may add columns; with
        ``drops`` it may also leave rows out, and keys that have none left stay unseen. ``prepare_dealt``
        takes its place when no key has more than ``HOT_ROWS`` rows, and no more have none: it deals the
        rows by key into that number of buckets, and they are looked up as they are dealt, in one shuffle.
        Rows that NOT NULL rejects make no key known and are counted whenever they come.
        """
        load, ledger, key = load or uuid.uuid4().hex, self.ledger(table), self.key(table)
        ids = table.primary_key
        if ledger.exists:
            ledger.recover(self.scan(table) if self.exists(table) else None, key, ids)
            if ledger.finished(load):
                return Load(table.name, 0, 0, {})
        elif self.exists(table):
            ledger.adopt(self.scan(table), key, ids)
        here = [c for c in table.required if c in incoming.columns]
        rejected = F.lit(False) if not here else reject_reason(here).isNotNull()
        ledger.open(load, incoming.select(F.when(~rejected, key).alias(KEY)), *bounds)
        first = ledger.next_id() if ids else None
        dealt = prepare_dealt is not None and ledger.most(load) <= HOT_ROWS
        prepare = prepare_dealt if dealt else prepare
        rows = unseen_rows(incoming, key, ledger, load, rejected, dealt)
        if not drops:
            done = self.append(table, prepare(rows, first, ledger.buckets) if prepare else rows, load_ts, evolve)
        else:
            with temporary(prepare(rows, first, ledger.buckets), f"load-{table.name}", "zstd") as kept:
                ledger.narrow(load, kept.select(key.alias(KEY)))
                done = self.append(table, kept, load_ts, evolve)
        ledger.finish(load, first, max(first, done.next_id or 0) if ids else None)
        return done


class ConnectorWarehouse(Warehouse):
    """The same layers with all rows behind a connector; the key ledgers stay in the catalog, under ``root``.

    ``connector`` is a Spark data source that takes the table's name as ``dbtable``. A table exists
    there when it has columns; a connector that raises for a missing table has to be given its
    tables first. The connector makes a table, and adds columns, as rows with them are appended.
    """

    def __init__(self, spark: SparkSession, root: str, connector: str, options: Mapping[str, str], **more):
        super().__init__(spark, root, **more)
        self.connector, self.options = connector, dict(options)

    def _stored(self, table: Table) -> DataFrame:
        return scan_connector(self.spark, self.connector, self.options, self.name(table))

    def exists(self, table: Table) -> bool:
        return bool(self._stored(table).columns)

    def create(self, table: Table, schema: T.StructType | None = None) -> None:
        """An append without rows leaves the columns."""
        if not self.exists(table):
            columns = [T.StructField(f.name, f.dataType) for f in (schema or table.schema)]
            empty = no_rows(self.spark, T.StructType(columns))
            append_connector(empty, self.connector, self.options, self.name(table))

    def scan(self, table: Table) -> DataFrame:
        stored = self._stored(table)
        if not stored.columns:
            return no_rows(self.spark, table.schema)
        declared = [c for c in table.schema.names if c in stored.columns]
        return stored.select(*declared, *[c for c in stored.columns if c not in declared])

    def add_columns(self, table: Table, fields: list[T.StructField]) -> None:
        """They come with the rows that have them."""

    def _insert(self, table: Table, rows: DataFrame, load_ts: datetime | None) -> None:
        append_connector(rows, self.connector, self.options, self.name(table))


def unseen_rows(
    incoming: DataFrame, key: Column, ledger: KeyLedger, load: str, also: Column, dealt: bool = False
) -> DataFrame:
    """``with_keys`` for the keys that ``ledger`` opened ``load`` with out of those of ``incoming``.

    Where the ledger counted that all of them or none are unseen, no key has to be looked up and
    the rows stay where they are.
    """
    arrived, unseen = ledger.share(load)
    if arrived == unseen:
        return incoming
    if not unseen:
        return incoming.filter(key.isNull() | also)
    if dealt:
        return dealt_with_keys(incoming, key, ledger.opened(load), also, ledger.buckets)
    return with_keys(incoming, key, ledger.opened(load), also)


def with_keys(incoming: DataFrame, key: Column, keys: DataFrame, also: Column) -> DataFrame:
    """Rows of ``incoming`` whose key is one of the distinct ``keys``, is NULL, or for which ``also`` holds.

    Only the keys of one load are on the right. Comparing a digest as well gives both sides
    exchanges of their own, so adaptive execution can split a hot key. The rows are shuffled
    with no column but their own.
    """
    wanted = keys.withColumnRenamed(KEY, "_wanted")
    same = (key == F.col("_wanted")) & (F.xxhash64(key) == F.xxhash64("_wanted"))
    found = incoming.join(wanted, same, "left")
    return found.filter(F.col("_wanted").isNotNull() | key.isNull() | also).drop("_wanted")


def dealt_with_keys(incoming: DataFrame, key: Column, keys: DataFrame, also: Column, buckets: int) -> DataFrame:
    """``with_keys`` for rows that go on to be dealt by key into the ledger's ``buckets``: one shuffle for both."""
    wanted = keys.withColumnRenamed(KEY, "_wanted")
    found = incoming.repartition(buckets, key).join(wanted, key == F.col("_wanted"), "left")
    return found.filter(F.col("_wanted").isNotNull() | key.isNull() | also).drop("_wanted")

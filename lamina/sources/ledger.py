"""What a table's loads brought: their keys, the range of their keys, and the ids they took.

Two tables stand next to every target. ``<table>_KEYS`` has each distinct key once, in
buckets by key and sorted within them, with a partition per load. ``<table>_LOADS`` has a
row per finished load: number, smallest and largest of its keys, and the surrogate ids it
took. A load whose row is missing has not happened: its keys are not seen by anybody.

A comparison with what is stored reads these keys and not the target. It is a join of
buckets, so only the increment's keys are shuffled, and it leaves out loads whose range of
keys does not meet the increment's.

One writer at a time loads a table. A load that was cut short left its keys behind without
a row; ``recover`` looks for them in the target, whose own append is all or nothing, and
either finishes the load or forgets it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, LOAD = "LEDGER_KEY", "LEDGER_LOAD"
#: Between the parts of a key of several columns.
PART_END = "\x1f"
_KNOWN, _TIMES = "_known", "_times"

LOADS_SCHEMA = T.StructType(
    [
        T.StructField("LOAD", T.StringType()),
        T.StructField("KEYS", T.LongType()),
        T.StructField("LOW", T.StringType()),
        T.StructField("HIGH", T.StringType()),
        T.StructField("FIRST_ID", T.LongType()),
        T.StructField("NEXT_ID", T.LongType()),
        T.StructField("REPLACES", T.ArrayType(T.StringType())),
    ]
)


def key_of(columns: Sequence[str]) -> Column:
    """The key as text; NULL when any of its columns is NULL."""
    parts = [F.col(c).cast("string") for c in columns]
    return parts[0] if len(parts) == 1 else F.concat(*[x for p in parts for x in (p, F.lit(PART_END))])


class KeyLedger:
    """The keys and loads of the table ``name`` (with its database). It reads the list of loads once."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark, self.name = spark, name
        self.keys_table, self.loads_table = f"{name}_KEYS", f"{name}_LOADS"
        self._asked = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._rows: list[Row] | None = None
        self._written: dict[str, tuple] = {}
        self._asked_for: dict[str, int] = {}
        self._most: dict[str, int] = {}

    @cached_property
    def buckets(self) -> int:
        """As many as the table was made with."""
        if not self.spark.catalog.tableExists(self.keys_table):
            return self._asked
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.keys_table}").collect()
        return next(int(row.data_type) for row in described if row.col_name == "Num Buckets")

    def create(self) -> None:
        self.spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {self.keys_table} ({KEY} STRING, {LOAD} STRING) USING parquet
            OPTIONS (compression 'zstd') PARTITIONED BY ({LOAD}) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self._asked} BUCKETS"""
        )
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOADS_SCHEMA)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.loads_table} ({columns}) USING parquet")

    @property
    def exists(self) -> bool:
        return self._rows is not None or self.spark.catalog.tableExists(self.loads_table)

    def _finished(self) -> list[Row]:
        """A small row for each finished load."""
        if self._rows is None and self.exists:
            self._rows = self.spark.table(self.loads_table).collect()
        return self._rows or []

    def loads(self) -> list[Row]:
        """Finished loads that no later one replaced."""
        replaced = {load for row in self._finished() for load in row.REPLACES or ()}
        return [row for row in self._finished() if row.LOAD not in replaced]

    def in_reach(self, low: str | None = None, high: str | None = None) -> list[str]:
        """The loads that may hold a key from ``low`` to ``high``; keys compare as the bytes of their text."""
        return [
            row.LOAD
            for row in self.loads()
            if row.KEYS
            and (low is None or row.HIGH.encode() >= low.encode())
            and (high is None or row.LOW.encode() <= high.encode())
        ]

    def stored(self, low: str | None = None, high: str | None = None) -> DataFrame | None:
        """The keys of all finished loads, or of those ``in_reach``; None when there is nothing to read."""
        meeting = self.in_reach(low, high)
        return self._keys(meeting) if meeting else None

    def _keys(self, loads: Sequence[str]) -> DataFrame:
        return self.spark.table(self.keys_table).filter(F.col(LOAD).isin(list(loads))).select(KEY)

    def unseen(self, keys: DataFrame, low: str | None = None, high: str | None = None) -> DataFrame:
        """Distinct keys of ``keys`` (KEY) that no finished load has, dealt as the buckets are.

        Repeats collapse before the shuffle; the stored side is read bucket by bucket and stays
        where it is, however many partitions the session shuffles into. That takes the outer
        form: an anti-join would slip below the repartitioning, which then deals both sides.
        Stored keys are distinct, so no row comes twice.
        """
        return self._compared(keys.dropna(), low, high).filter(~F.col(_KNOWN)).select(KEY)

    def _compared(self, keys: DataFrame, low: str | None = None, high: str | None = None) -> DataFrame:
        """The distinct keys (one of them may be NULL), how often each came, and whether a finished load has it."""
        ours = keys.groupBy(KEY).agg(F.count("*").alias(_TIMES)).repartition(self.buckets, KEY)
        stored = self.stored(low, high)
        if stored is None:
            return ours.withColumn(_KNOWN, F.lit(False))
        seen = stored.withColumnRenamed(KEY, "_seen")
        found = ours.join(seen, F.col(KEY) == F.col("_seen"), "left")
        return found.select(KEY, _TIMES, F.col("_seen").isNotNull().alias(_KNOWN))

    def open(self, load: str, keys: DataFrame, low: str | None = None, high: str | None = None) -> None:
        """Write the unseen ones of ``keys`` (KEY; NULL is none) under ``load``, which is not finished by that."""
        if not self.exists:
            self.create()
        self._write(load, self._compared(keys, low, high))

    def share(self, load: str) -> tuple[int, int]:
        """How many distinct keys ``load`` was opened with, and how many of them no finished load had."""
        return self._asked_for[load], self._written[load][0]

    def most(self, load: str) -> int:
        """The most rows that came under one key, or without one, when ``load`` was opened."""
        return self._most[load]

    def narrow(self, load: str, keys: DataFrame) -> None:
        """Keep only ``keys`` (KEY, repeats allowed) of an open load."""
        self._write(load, keys.dropna().distinct().repartition(self.buckets, KEY))

    def _write(self, load: str, keys: DataFrame) -> None:
        if self.finished(load):
            raise ValueError(f"load {load!r} of {self.name} is finished")
        self._forget(load)
        if _KNOWN not in keys.columns:
            keys = keys.withColumns({_KNOWN: F.lit(False), _TIMES: F.lit(1)})
        observation, fresh = Observation(f"{self.name} {load}"), F.when(~F.col(_KNOWN), F.col(KEY))
        counted = keys.observe(
            observation, F.count(KEY).alias("all"), F.max(_TIMES).alias("most"), F.count(fresh).alias("n"), F.min(fresh).alias("low"), F.max(fresh).alias("high"),
        )
        into = f"INSERT INTO {self.keys_table} PARTITION ({LOAD} = '{load}')"
        self.spark.sql(f"{into} SELECT {KEY} FROM {{keys}}", keys=counted.filter(~F.col(_KNOWN) & F.col(KEY).isNotNull()))
        self._asked_for[load], self._most[load] = observation.get["all"], observation.get["most"] or 0
        self._written[load] = tuple(observation.get[c] for c in ("n", "low", "high"))

    def _forget(self, load: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.keys_table} DROP IF EXISTS PARTITION ({LOAD} = '{load}')")

    def opened(self, *loads: str) -> DataFrame:
        """The keys of ``loads``, finished or not."""
        return self._keys(loads)

    def finish(
        self, load: str, first_id: int | None = None, next_id: int | None = None, replaces: Sequence[str] = ()
    ) -> Row:
        """Make the load count: one row, the last thing a load writes."""
        if load not in self._written:
            keys = self.opened(load).agg(F.count("*"), F.min(KEY), F.max(KEY))
            self._written[load] = tuple(keys.first())
        values = [load, *self._written[load], first_id, next_id, list(replaces)]
        named = {f"v{i}": v for i, v in enumerate(values[:-1])}
        casts = [f"cast(:v{i} as {f.dataType.simpleString()})" for i, f in enumerate(LOADS_SCHEMA[:-1])]
        replaced = ", ".join(f":r{i}" for i in range(len(replaces)))
        named |= {f"r{i}": v for i, v in enumerate(replaces)}
        self.spark.sql(
            f"INSERT INTO {self.loads_table} SELECT {', '.join(casts)}, cast(array({replaced}) as array<string>)", named
        )
        row = Row(*LOADS_SCHEMA.names)(*values)
        self._rows = [*self._finished(), row] if self._rows is not None else None
        return row

    def finished(self, load: str) -> bool:
        return any(row.LOAD == load for row in self._finished())

    def next_id(self) -> int:
        """The first id that no finished load took: a load that is run again gets the same."""
        return max((row.NEXT_ID for row in self._finished() if row.NEXT_ID is not None), default=0)

    def open_loads(self) -> list[str]:
        """Loads that were begun and not finished."""
        if not self.exists:
            return []
        begun = [row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self.keys_table}").collect()]
        return [load for load in begun if not self.finished(load)]

    def recover(self, target: DataFrame | None, key: Column, id_col: str | None = None) -> dict[str, bool]:
        """Finish the open loads whose rows are in ``target`` and forget the others; which was which."""
        settled = {}
        for load in self.open_loads():
            rows = None
            if target is not None:
                keys = self.opened(load).withColumnRenamed(KEY, "_opened")
                rows = target.withColumn("_key", key).join(keys, F.col("_key") == F.col("_opened"), "left_semi")
            settled[load] = rows is not None and not rows.isEmpty()
            if settled[load]:
                ids = rows.agg(F.min(id_col), F.max(id_col) + 1).first() if id_col else (None, None)
                self.finish(load, *ids)
            else:
                self._forget(load)
        return settled

    def adopt(self, target: DataFrame, key: Column, id_col: str | None = None, load: str = "adopted") -> None:
        """Take the keys of a table that was filled without a ledger."""
        ids = (0, target.agg(F.coalesce(F.max(id_col) + 1, F.lit(0))).first()[0]) if id_col else (None, None)
        self.open(load, target.select(key.alias(KEY)))
        self.finish(load, *ids)

    def compact(self, load: str) -> None:
        """All finished loads as one, under the name ``load``: a file per bucket in place of one per load.

        The new row names those it replaces, so readers change over at once; their keys go afterwards.
        """
        old = self.loads()
        if len(old) < 2:
            return
        # The same hash as of the key itself, but not known as such: else the repartitioning would
        # count as done by the buckets, which are then read file by file.
        dealt = self._keys([row.LOAD for row in old]).repartition(self.buckets, F.concat(KEY, F.lit("")))
        self._write(load, dealt)
        ids = [row for row in old if row.NEXT_ID is not None]
        first, after = (min(r.FIRST_ID for r in ids), max(r.NEXT_ID for r in ids)) if ids else (None, None)
        self.finish(load, first, after, [row.LOAD for row in old])
        for row in old:
            self._forget(row.LOAD)

"""Every operator as a query over the order tables: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import load_stamp, natural_key
from lamina.operators import cleaning, quality
from lamina.operators.evolution import conform, schema_diff
from lamina.operators.incremental import new_rows
from lamina.operators.profiling import observed, profile_frame
from lamina.operators.star import (
    COUNTRY,
    DATE,
    DIMENSIONS,
    KEY,
    LINE,
    PRODUCT,
    Dimension,
    dimension_rows,
    fact_rows,
    star,
)
from lamina.operators.surrogate import dense_ids, next_id
from lamina.plans.checks import check_run
from lamina.plans.layers import (
    load_bronze,
    load_dimension_map,
    load_fact,
    load_mapped_dimension,
    load_silver,
    resolved_facts,
    run_layers,
)
from lamina.schemas import (
    COUNTRY_DIM,
    DIMENSION_KEY,
    DIMENSION_MAP,
    FACT_KEY,
    INVOICE,
    INVOICE_FACT_TABLE,
    INVOICE_GOLD,
    INVOICE_SILVER,
    TABLES,
)
from lamina.session import fresh_path, materialize
from lamina.sources.committed import FORMAT, CommittedTables
from lamina.sources.csv_files import read_csv_by_header, read_csv_folder, write_csv_folder
from lamina.sources.invoices import EXTRA_COLUMNS, invoice_lines
from lamina.sources.ledger import KEY as LEDGER_KEY
from lamina.sources.ledger import key_of
from lamina.sources.tables import HOT_ROWS, ConnectorWarehouse, Warehouse, is_empty, unseen_rows
from lamina.streaming.arrivals import arriving_lines, start_folder_load, start_incremental_load

Query = Callable[[SparkSession, str], DataFrame]

# The load stamp of every query, and the day before which lines count as stored.
STAMP = datetime(2024, 1, 31, 12, 34)
CUTOFF = date(1998, 1, 1)
LATER_COLUMNS = ("LINESTATUS", "SHIPDATE", "TAX", "LINENUMBER")
KEY_COLUMN = "INVOICENO_STOCKCODE"
INVOICE_ORDER = [FACT_KEY, "QUANTITY", "UNITPRICE"]

_registry: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register ``f`` under its name; a trailing underscore keeps clear of the operator it runs."""
    _registry[f.__name__.rstrip("_")] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_registry)


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.silver_typed(invoice_lines(spark, folder), STAMP)


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.invoices(_typed(spark, folder))


def _cancelled(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cancelled(_typed(spark, folder))


def _lines(spark: SparkSession, folder: str, extra: Iterable[str] = ()) -> DataFrame:
    """The lines of a query that reads them several times: joined once."""
    return materialize(invoice_lines(spark, folder, extra), "lines", "zstd")


def _kept_silver(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(_silver(spark, folder), "silver", "zstd")


def _stored(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("FECHA_INVOICE") < F.lit(CUTOFF))


def _stored_bronze(bronze: DataFrame) -> DataFrame:
    return _stored(cleaning.with_invoice_dates(bronze)).select(*bronze.columns)


def _warehouse(spark: SparkSession) -> Warehouse:
    name = f"retail_{uuid.uuid4().hex[:12]}"
    return Warehouse(spark, fresh_path(spark, name), prefix=name)


# Bronze and silver


@query
def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return invoice_lines(spark, folder)


@query
def bronze_project(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.project_required(invoice_lines(spark, folder, EXTRA_COLUMNS))


@query
def silver_dates(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.with_invoice_dates(invoice_lines(spark, folder)).select(
        "INVOICENO", "STOCKCODE", "INVOICEDATE", "FECHA_INVOICE", "HORA_MINUTO_VARCHAR"
    )


@query
def audit_stamp(spark: SparkSession, folder: str) -> DataFrame:
    return invoice_lines(spark, folder).select("INVOICENO", "STOCKCODE").withColumns(load_stamp(STAMP))


@query
def silver_required(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_incomplete(invoice_lines(spark, folder))


@query
def silver_fill(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.fill_description(invoice_lines(spark, folder))


@query
def silver_cast(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cast_numbers(invoice_lines(spark, folder)).select(
        "INVOICENO", "STOCKCODE", "QUANTITY", "UNITPRICE"
    )


@query
def silver_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder)


@query
def silver_route(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.with_route(_typed(spark, folder))


@query
def silver_invoices(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder)


@query
def silver_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    return _cancelled(spark, folder)


# Incremental loads by invoice


def _unseen(lines: DataFrame, stored: DataFrame) -> DataFrame:
    """The lines whose invoice is not in the key ledger that ``stored`` left."""
    wh, key = _warehouse(lines.sparkSession), key_of([INVOICE.load_key])
    ledger = wh.ledger(INVOICE)
    for load, rows in (("stored", stored), ("new", lines)):
        ledger.open(load, rows.select(key.alias(LEDGER_KEY)))
        if load == "stored":
            ledger.finish(load)
    return unseen_rows(lines, key, ledger, "new", F.lit(False))


@query
def incr_bronze(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return _unseen(lines, _stored_bronze(lines))


@query
def incr_silver(spark: SparkSession, folder: str) -> DataFrame:
    lines = _kept_silver(spark, folder)
    return _unseen(lines, _stored(lines))


@query
def incr_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    lines = materialize(_cancelled(spark, folder), "cancelled", "zstd")
    return _unseen(lines, _stored(lines))


@query
def gold_invoice(spark: SparkSession, folder: str) -> DataFrame:
    return conform(cleaning.gold_invoice(_silver(spark, folder), STAMP), INVOICE_GOLD.schema)


@query
def incr_gold(spark: SparkSession, folder: str) -> DataFrame:
    lines = materialize(gold_invoice(spark, folder), "gold", "zstd")
    return _unseen(lines, _stored(lines))


@query
def gold_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    return conform(cleaning.gold_invoice(_cancelled(spark, folder), STAMP), INVOICE_GOLD.schema)


# Keys, ids and dimensions


@query
def natural_key_(spark: SparkSession, folder: str) -> DataFrame:
    return invoice_lines(spark, folder).select("INVOICENO", "STOCKCODE", natural_key().alias(KEY_COLUMN))


@query
def surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the lines that are not stored go on after the ids of those that are."""
    facts = fact_rows(_kept_silver(spark, folder), STAMP).select(*INVOICE_ORDER, "FECHA_INVOICE")
    stored = dense_ids(_stored(facts), "INVOICE_FACT_ID", rows_stored=True)
    unseen = new_rows(facts, stored, FACT_KEY)
    return dense_ids(unseen, "INVOICE_FACT_ID", start=next_id(stored, "INVOICE_FACT_ID"))


def _numbered(rows: DataFrame, dim: Dimension, start: int = 0, rows_stored: bool = False) -> DataFrame:
    ordered = dense_ids(rows, dim.id_col, [DIMENSION_KEY, *dim.attributes], start, rows_stored)
    return ordered.select(*dim.table.schema.names)


def _dimension(lines: DataFrame, dim: Dimension, grain: str = LINE) -> DataFrame:
    """``dim`` with ids over stored ``lines``. At key grain no two rows tie, so they need not be stored first."""
    accepted, _ = quality.split_required(dimension_rows(lines, dim, STAMP, grain), dim.table.required)
    return _numbered(accepted, dim, rows_stored=True)


def _unseen_dimension(lines: DataFrame, dim: Dimension) -> DataFrame:
    stored = _dimension(_stored(lines), dim)
    accepted, _ = quality.split_required(dimension_rows(lines, dim, STAMP), dim.table.required)
    return _numbered(new_rows(accepted, stored, DIMENSION_KEY), dim, next_id(stored, dim.id_col))


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension(_kept_silver(spark, folder), DATE)


@query
def dim_country(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension(_kept_silver(spark, folder), COUNTRY)


@query
def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension(_kept_silver(spark, folder), PRODUCT)


@query
def incr_date_dim(spark: SparkSession, folder: str) -> DataFrame:
    return _unseen_dimension(_kept_silver(spark, folder), DATE)


@query
def incr_country_dim(spark: SparkSession, folder: str) -> DataFrame:
    return _unseen_dimension(_kept_silver(spark, folder), COUNTRY)


@query
def incr_product_dim(spark: SparkSession, folder: str) -> DataFrame:
    return _unseen_dimension(_kept_silver(spark, folder), PRODUCT)


# Facts


def _numbered_facts(lines: DataFrame, start: int = 0, rows_stored: bool = True) -> DataFrame:
    return dense_ids(lines, INVOICE_FACT_TABLE.primary_key, INVOICE_ORDER, start, rows_stored)


def _parts(lines: DataFrame) -> int | None:
    """The tasks that lines may be dealt to by key; None where a key has more lines than one task should get."""
    most = lines.groupBy(natural_key()).count().agg(F.max("count")).first()[0]
    return int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")) if (most or 0) <= HOT_ROWS else None


def _facts(spark: SparkSession, folder: str, grain: str) -> DataFrame:
    lines = _kept_silver(spark, folder)
    dims = {dim.table.name: _dimension(lines, dim, grain) for dim in DIMENSIONS}
    facts = _numbered_facts(fact_rows(lines, STAMP))
    return conform(star(facts, dims, grain, _parts(lines) if grain == KEY else None), INVOICE_FACT_TABLE.schema)


@query
def gold_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Matched on the natural key: k lines under one key give k^4 rows."""
    return _facts(spark, folder, LINE)


@query
def gold_fact_per_line(spark: SparkSession, folder: str) -> DataFrame:
    """Matched on key and attributes: one row per line."""
    return _facts(spark, folder, KEY)


@query
def incr_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose key is not stored, with ids after the stored ones, joined to all dimensions."""
    lines = _kept_silver(spark, folder)
    dims = {dim.table.name: _dimension(lines, dim) for dim in DIMENSIONS}
    stored = _numbered_facts(fact_rows(_stored(lines), STAMP))
    unseen = new_rows(fact_rows(lines, STAMP), stored, FACT_KEY)
    numbered = _numbered_facts(unseen, next_id(stored, INVOICE_FACT_TABLE.primary_key), rows_stored=False)
    return conform(star(numbered, dims), INVOICE_FACT_TABLE.schema)


def _loaded_facts(spark: SparkSession, folder: str) -> tuple[Warehouse, DataFrame]:
    """Dimension map, dimensions and facts of two increments of silver lines."""
    wh, lines = _warehouse(spark), _kept_silver(spark, folder)
    for part in (_stored(lines), lines):
        load_dimension_map(wh, part)
        for dim in DIMENSIONS:
            load_mapped_dimension(wh, dim, STAMP)
        load_fact(wh, part, STAMP)
    return wh, lines


@query
def fact_by_map(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads through the dimension map; the facts with their ids looked up in the dimensions."""
    return resolved_facts(_loaded_facts(spark, folder)[0])


def _shared_ids(found: DataFrame, dim: Dimension) -> DataFrame:
    """The ids of ``dim`` that several rows of the map have, and whether all rows of an id are alike (FITS).

    Ids are shuffled alone. Those that repeat are stored, so the planner knows that they are few
    when the rows that have them are looked up.
    """
    counted = found.groupBy(dim.id_col).agg(F.count("*").alias("n")).filter(F.col(dim.id_col).isNotNull() & (F.col("n") > 1))
    rows = found.join(materialize(counted.select(dim.id_col), "repeated-ids"), dim.id_col)
    values = F.struct(DIMENSION_KEY, *dim.attributes)
    return rows.groupBy(dim.id_col).agg((F.min(values) == F.max(values)).alias("FITS"))


@query
def dimension_map(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of the map: its rows, and whether each id stands for one row of its dimension."""
    wh, lines = _warehouse(spark), _kept_silver(spark, folder)
    load_dimension_map(wh, _stored(lines))
    load_dimension_map(wh, lines)
    found = wh.scan(DIMENSION_MAP)
    stored = found
    for dim in DIMENSIONS:
        fits = f"{dim.id_col}_FITS"
        shared = materialize(_shared_ids(stored, dim), "shared-ids")
        found = found.join(shared.withColumnRenamed("FITS", fits), dim.id_col, "left")
        found = found.withColumn(fits, F.when(F.col(dim.id_col).isNotNull(), F.coalesce(fits, F.lit(True))))
    attributes = [name for dim in DIMENSIONS for name in dim.attributes]
    return found.select(DIMENSION_KEY, *attributes, *[f"{dim.id_col}_FITS" for dim in DIMENSIONS])


@query
def ids_by_load(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and ids of each table and load, and the ids outside the range that the load took."""
    wh, _ = _loaded_facts(spark, folder)
    parts = []
    for table in [dim.table for dim in DIMENSIONS] + [INVOICE_FACT_TABLE]:
        ranges = [(r.FIRST_ID, r.NEXT_ID) for r in wh.ledger(table).loads() if r.NEXT_ID > r.FIRST_ID]
        taken = [(i, *r) for i, r in enumerate(sorted(ranges))]
        loads = spark.createDataFrame(taken, "LOAD_NUMBER int, FIRST_ID long, NEXT_ID long")  # one row per load
        own = wh.scan(table).select(F.lit(table.name).alias("TABLE_NAME"), F.col(table.primary_key).alias("ID"))
        inside = (F.col("ID") >= F.col("FIRST_ID")) & (F.col("ID") < F.col("NEXT_ID"))
        parts.append(own.join(F.broadcast(loads), inside, "left").groupBy("TABLE_NAME", "LOAD_NUMBER").agg(
            F.count("*").alias("ROW_COUNT"), F.countDistinct("ID").alias("ID_COUNT")
        ))
    return reduce(DataFrame.union, parts)


@query
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return fact_rows(_silver(spark, folder), STAMP).distinct()


@query
def distinct_products(spark: SparkSession, folder: str) -> DataFrame:
    """Which products were sold to which countries: far fewer rows than lines."""
    return _silver(spark, folder).select("STOCKCODE", "COUNTRY").distinct()


# Constraints and profile


@query
def reject_not_null(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = quality.split_required(dimension_rows(_silver(spark, folder), DATE, STAMP), DATE.table.required)
    return rejected


@query
def check_pk(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repeated_keys(dimension_rows(_silver(spark, folder), COUNTRY, STAMP), DIMENSION_KEY)


@query
def check_fk(spark: SparkSession, folder: str) -> DataFrame:
    """Facts that no accepted row of the date dimension stands behind."""
    lines = _silver(spark, folder)
    dates, _ = quality.split_required(dimension_rows(lines, DATE, STAMP), DATE.table.required)
    facts = fact_rows(lines, STAMP).select(FACT_KEY, "QUANTITY", "UNITPRICE")
    return quality.orphans(facts, FACT_KEY, dates, DIMENSION_KEY)


@query
def check_declared(spark: SparkSession, folder: str) -> DataFrame:
    """Declared keys of two loads; the later one brings violations.

    On purpose facts of one quantity share an id, facts of some others refer to products that are
    not there, and one country's dimension rows come once more without an id. The earlier load
    has no violation.
    """
    wh, lines = _warehouse(spark), _kept_silver(spark, folder)
    quantity = F.col("QUANTITY")

    class Spoilt(Warehouse):
        def append(self, table, df, *more, **named):
            if table.name == INVOICE_FACT_TABLE.name:
                wrong = F.when(quantity == 7, F.lit(-7)).otherwise(F.col("INVOICE_FACT_ID"))
                gone = F.when(quantity.between(10, 12), -quantity.cast("long")).otherwise(F.col("PRODUCT_ID"))
                df = df.withColumns({"INVOICE_FACT_ID": wrong, "PRODUCT_ID": gone})
            if table.name == COUNTRY_DIM.name:
                df = df.union(df.filter("COUNTRY = 'FRANCE'").withColumn("COUNTRY_ID", F.lit(None).cast("long")))
            return super().append(table, df, *more, **named)

    spoilt = Spoilt(spark, wh.root, wh.prefix)
    for load, part, target in (("early", _stored(lines), wh), ("late", lines, spoilt)):
        load_dimension_map(target, part, load)
        for dim in DIMENSIONS:
            load_mapped_dimension(target, dim, STAMP)
        load_fact(target, part, STAMP, load=load)
    return reduce(DataFrame.unionByName, [check_run(wh, load, STAMP) for load in ("early", "late")])


@query
def load_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Counts taken by the write itself."""
    lines = invoice_lines(spark, folder)
    counted, observation = observed(lines, "load_profile")
    counted.write.parquet(fresh_path(spark, "profile"))
    return profile_frame(lines, observation)


# Through storage


@query
def bronze_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    write_csv_folder(invoice_lines(spark, folder), path)
    return read_csv_folder(spark, path)


@query
def bronze_csv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV deliveries with their columns in other orders, the later one with a column more."""
    wh, path = _warehouse(spark), fresh_path(spark, "csv")
    lines = _lines(spark, folder, ["LINENUMBER"])
    names = [c for c in lines.columns if c != "LINENUMBER"]
    write_csv_folder(_stored_bronze(lines).select(*reversed(names)), f"{path}/first")
    write_csv_folder(lines.select("LINENUMBER", *names[3:], *names[:3]), f"{path}/second")
    for delivery in ("first", "second"):
        load_bronze(wh, read_csv_folder(spark, f"{path}/{delivery}"))
    return wh.scan(INVOICE)


@query
def stream_csv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The same deliveries through the streaming load, each from its own folder."""
    wh, path = _warehouse(spark), fresh_path(spark, "arrivals")
    lines = _lines(spark, folder, ["LINENUMBER"])
    names = [c for c in lines.columns if c != "LINENUMBER"]
    write_csv_folder(_stored_bronze(lines).select(*reversed(names)), f"{path}/first")
    write_csv_folder(lines.select("LINENUMBER", *names[3:], *names[:3]), f"{path}/second")
    for delivery in ("first", "second"):
        stream = arriving_lines(spark, f"{path}/{delivery}")
        start_incremental_load(wh, stream, fresh_path(spark, "stream"), STAMP, once=True).awaitTermination()
    return wh.scan(INVOICE)


def _three_headers(spark: SparkSession, folder: str) -> str:
    """One folder of CSV files with three headers: other orders, a column more, one less and another one more."""
    path, lines = fresh_path(spark, "csv"), _lines(spark, folder, ["LINENUMBER", "LINESTATUS"])
    third = F.regexp_replace("INVOICENO", "C", "").cast("long") % 3
    names = [c for c in lines.columns if c not in ("LINENUMBER", "LINESTATUS")]
    headers = [names[::-1], ["LINENUMBER", *names], [*[c for c in names if c != "COUNTRY"], "LINESTATUS"]]
    for number, header in enumerate(headers):
        write_csv_folder(lines.filter(third == number).select(*header), path, "append")
    return path


@query
def bronze_csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files of three headers in one folder, each read by its own and united by name."""
    wh = _warehouse(spark)
    load_bronze(wh, read_csv_by_header(spark, _three_headers(spark, folder)))
    return wh.scan(INVOICE)


@query
def stream_csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder through the streaming load."""
    wh = _warehouse(spark)
    path = _three_headers(spark, folder)
    start_folder_load(wh, path, fresh_path(spark, "stream"), STAMP, once=True).awaitTermination()
    return wh.scan(INVOICE)


@query
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    wh = _warehouse(spark)
    wh.append(INVOICE_SILVER, _silver(spark, folder), STAMP)
    return wh.scan(INVOICE_SILVER)


@query
def append_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """A part, then everything, then everything again."""
    wh, lines = _warehouse(spark), _lines(spark, folder)
    load_bronze(wh, _stored_bronze(lines))
    load_bronze(wh, lines)
    load_bronze(wh, lines)
    return wh.scan(INVOICE)


@query
def connector_load(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze and silver loaded twice into a connector, with a column more the second time; the silver lines there."""
    spark.dataSource.register(CommittedTables)
    name = f"retail_{uuid.uuid4().hex[:12]}"
    root = fresh_path(spark, name)
    wh = ConnectorWarehouse(spark, root, FORMAT, {"folder": f"{root}/connector"}, prefix=name)
    lines = _lines(spark, folder, ["LINENUMBER"])
    for delivery in (_stored_bronze(lines.drop("LINENUMBER")), lines):
        load_bronze(wh, delivery)
        load_silver(wh, STAMP)
    return wh.scan(INVOICE_SILVER)


@query
def bronze_first_load(spark: SparkSession, folder: str) -> DataFrame:
    """The first load creates the table from the columns that arrive."""
    wh = _warehouse(spark)
    load_bronze(wh, invoice_lines(spark, folder, ["LINENUMBER"]))
    return wh.scan(INVOICE)


@query
def schema_evolve_append(spark: SparkSession, folder: str) -> DataFrame:
    """A later delivery brings columns the stored rows do not have."""
    wh, lines = _warehouse(spark), _lines(spark, folder, LATER_COLUMNS)
    load_bronze(wh, _stored_bronze(lines.drop(*LATER_COLUMNS)))
    load_bronze(wh, lines)
    return wh.scan(INVOICE)


@query
def bronze_types_kept(spark: SparkSession, folder: str) -> DataFrame:
    """A later delivery has halves among the quantities and text among the prices: the silver lines they give."""
    wh, path = _warehouse(spark), fresh_path(spark, "csv")
    lines = _lines(spark, folder)
    odd = {
        "QUANTITY": F.when(F.col("CUSTOMERID") % 3 == 0, F.col("QUANTITY") + 0.5).otherwise(F.col("QUANTITY") + 0.0),
        "UNITPRICE": F.when(F.col("CUSTOMERID") % 7 == 0, "n/a").otherwise(F.col("UNITPRICE").cast("string")),
    }
    load_bronze(wh, _stored_bronze(lines))
    write_csv_folder(lines.withColumns(odd), path)
    load_bronze(wh, read_csv_folder(spark, path, schema=None))
    return cleaning.silver_typed(wh.scan(INVOICE), STAMP)


@query
def emptiness_probe(spark: SparkSession, folder: str) -> DataFrame:
    """A filled table, a table that was only created, and a table that does not exist."""
    wh = _warehouse(spark)
    wh.append(INVOICE, invoice_lines(spark, folder))
    wh.create(INVOICE_GOLD)
    probed = [(t.name, is_empty(wh.scan(t))) for t in (INVOICE, INVOICE_GOLD, COUNTRY_DIM)]
    return spark.createDataFrame(probed, "table_name string, is_empty boolean")


@query
def schema_diff_(spark: SparkSession, folder: str) -> DataFrame:
    wh, lines = _warehouse(spark), _lines(spark, folder, EXTRA_COLUMNS)
    load_bronze(wh, _stored_bronze(lines.drop(*EXTRA_COLUMNS)))
    return schema_diff(lines, wh.schema(INVOICE))


@query
def layered_run(spark: SparkSession, folder: str) -> DataFrame:
    """All layers for a first part and then for everything; facts with their ids looked up again."""
    wh, lines = _warehouse(spark), _lines(spark, folder)
    run_layers(wh, _stored_bronze(lines), STAMP)
    run_layers(wh, lines, STAMP)
    return resolved_facts(wh)


@query
def stream_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries; the later one is cut short once in every layer and taken up by a new query each time.

    Rows and keys of every table, and of the facts whose ids lead to their dimensions.
    """
    wh, lines = _warehouse(spark), _lines(spark, folder)
    arrivals, checkpoint = fresh_path(spark, "arrivals"), fresh_path(spark, "stream")
    early, lost = _stored_bronze(lines), set()

    class CutShort(Warehouse):
        def append(self, table, *given, **named):
            done = super().append(table, *given, **named)
            if table.name in (INVOICE_SILVER.name, DIMENSION_MAP.name, INVOICE_FACT_TABLE.name) and table.name not in lost:
                lost.add(table.name)
                raise InterruptedError(f"lost after the rows of {table.name}")
            return done

    def take(target: Warehouse) -> None:
        stream = arriving_lines(spark, f"{arrivals}/*")
        start_incremental_load(target, stream, checkpoint, STAMP, once=True).awaitTermination()

    write_csv_folder(early, f"{arrivals}/delivery-0")
    take(wh)
    write_csv_folder(new_rows(lines, early, INVOICE.load_key), f"{arrivals}/delivery-1")
    for cut in range(3):
        try:
            take(CutShort(spark, wh.root, wh.prefix))
        except StreamingQueryException:
            continue
        raise RuntimeError(f"the load should have been cut short, {cut} times until now")
    take(wh)
    counts = []
    for name, rows in [(t.name, wh.scan(t)) for t in TABLES.values()] + [("RESOLVED", resolved_facts(wh))]:
        key = TABLES[name].load_key if name in TABLES else FACT_KEY
        counts.append(rows.agg(
            F.lit(name).alias("TABLE_NAME"), F.count("*").alias("ROW_COUNT"), F.countDistinct(key).alias("KEY_COUNT")
        ))
    return reduce(DataFrame.union, counts)


@query
def stream_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of CSV files through the streaming load; the stored silver invoices."""
    wh, lines = _warehouse(spark), _lines(spark, folder)
    arrivals, checkpoint = fresh_path(spark, "arrivals"), fresh_path(spark, "stream")
    early = _stored_bronze(lines)
    for number, delivery in enumerate([early, new_rows(lines, early, INVOICE.load_key)]):
        write_csv_folder(delivery, f"{arrivals}/delivery-{number}")
        stream = arriving_lines(spark, f"{arrivals}/*")
        start_incremental_load(wh, stream, checkpoint, STAMP, once=True).awaitTermination()
    return wh.scan(INVOICE_SILVER)

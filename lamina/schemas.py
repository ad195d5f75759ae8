"""Declared tables: columns, load keys and constraints, one entry per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A stored table.

    ``load_key`` is the column that decides whether an incoming row is already
    stored. It and every column declared not nullable are required: rows without
    them are rejected at load. ``foreign_keys`` maps a column to (table, column).
    ``bucket_by`` names the column whose buckets the loads deal the rows into.
    """

    name: str
    layer: str
    schema: T.StructType
    load_key: str
    primary_key: str | None = None
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable or f.name == self.load_key]


def _columns(*specs: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, "required" not in rest) for n, t, *rest in specs])


STRING, DATE, LONG = T.StringType(), T.DateType(), T.LongType()
WORKING_DECIMAL = T.DecimalType(10, 2)
STORED_QUANTITY = T.DecimalType(38, 0)

# Table and column names of the layered model.
INVOICE_KEY = "INVOICENO"
DIMENSION_KEY = "FK_INVOICENO_STOCKCODE"
FACT_KEY = "PK_INVOICENO_STOCKCODE"
LOAD_DATE = "FECHA_DE_CARGA"
LOAD_TIME = "HORA_DE_CARGA"

INVOICE_SCHEMA = _columns(
    ("INVOICENO", STRING),
    ("STOCKCODE", STRING),
    ("DESCRIPTION", STRING),
    ("QUANTITY", T.IntegerType()),
    ("INVOICEDATE", STRING),
    ("UNITPRICE", T.DoubleType()),
    ("CUSTOMERID", LONG),
    ("COUNTRY", STRING),
)

_CLEAN_INVOICE = _columns(
    ("INVOICENO", STRING),
    ("STOCKCODE", STRING),
    ("DESCRIPTION", STRING, "required"),
    ("QUANTITY", STORED_QUANTITY),
    ("UNITPRICE", WORKING_DECIMAL),
    ("COUNTRY", STRING),
    ("FECHA_INVOICE", DATE),
    ("HORA_MINUTO_VARCHAR", STRING),
    ("FECHA_DE_CARGA", DATE),
    ("HORA_DE_CARGA", STRING, "required"),
)

_BY_LOAD = (LOAD_DATE,)

INVOICE = Table("INVOICE", "bronze", INVOICE_SCHEMA, INVOICE_KEY)
INVOICE_SILVER = Table("INVOICE_SILVER", "silver", _CLEAN_INVOICE, INVOICE_KEY, partition_by=_BY_LOAD)
INVOICE_CANCELLED_SILVER = Table(
    "INVOICE_CANCELLED_SILVER", "silver", _CLEAN_INVOICE, INVOICE_KEY, partition_by=_BY_LOAD
)
INVOICE_GOLD = Table("INVOICE_GOLD", "gold", _CLEAN_INVOICE, INVOICE_KEY, partition_by=_BY_LOAD)
INVOICE_CANCELLED_GOLD = Table(
    "INVOICE_CANCELLED_GOLD", "gold", _CLEAN_INVOICE, INVOICE_KEY, partition_by=_BY_LOAD
)
INVOICE_DATE_DIM = Table(
    "INVOICE_DATE_DIM",
    "gold",
    _columns(
        ("INVOICE_DATE_ID", LONG),
        ("FK_INVOICENO_STOCKCODE", STRING, "required"),
        ("FECHA_INVOICE", DATE, "required"),
        ("HORA_MINUTO", STRING, "required"),
        ("FECHA_DE_CARGA", DATE),
        ("HORA_DE_CARGA", STRING, "required"),
    ),
    DIMENSION_KEY,
    primary_key="INVOICE_DATE_ID",
    partition_by=_BY_LOAD,
)
COUNTRY_DIM = Table(
    "COUNTRY_DIM",
    "gold",
    _columns(
        ("COUNTRY_ID", LONG),
        ("FK_INVOICENO_STOCKCODE", STRING, "required"),
        ("COUNTRY", STRING, "required"),
        ("FECHA_DE_CARGA", DATE),
        ("HORA_DE_CARGA", STRING, "required"),
    ),
    DIMENSION_KEY,
    primary_key="COUNTRY_ID",
    partition_by=_BY_LOAD,
)
PRODUCT_DIM = Table(
    "PRODUCT_DIM",
    "gold",
    _columns(
        ("PRODUCT_ID", LONG),
        ("FK_INVOICENO_STOCKCODE", STRING, "required"),
        ("STOCKCODE", STRING, "required"),
        ("FECHA_DE_CARGA", DATE),
        ("HORA_DE_CARGA", STRING, "required"),
    ),
    DIMENSION_KEY,
    primary_key="PRODUCT_ID",
    partition_by=_BY_LOAD,
)
INVOICE_FACT_TABLE = Table(
    "INVOICE_FACT_TABLE",
    "gold",
    _columns(
        ("INVOICE_FACT_ID", LONG),
        ("PK_INVOICENO_STOCKCODE", STRING, "required"),
        ("PRODUCT_ID", LONG),
        ("COUNTRY_ID", LONG),
        ("INVOICE_DATE_ID", LONG),
        ("QUANTITY", STORED_QUANTITY),
        ("UNITPRICE", WORKING_DECIMAL),
        ("FECHA_DE_CARGA", DATE),
        ("HORA_DE_CARGA", STRING),
    ),
    FACT_KEY,
    primary_key="INVOICE_FACT_ID",
    foreign_keys={
        "PRODUCT_ID": ("PRODUCT_DIM", "PRODUCT_ID"),
        "COUNTRY_ID": ("COUNTRY_DIM", "COUNTRY_ID"),
        "INVOICE_DATE_ID": ("INVOICE_DATE_DIM", "INVOICE_DATE_ID"),
    },
    partition_by=_BY_LOAD,
)

#: One row per natural key and attribute values, with the ids of its rows in the three dimensions.
MAP_LOAD = "MAP_LOAD"
DIMENSION_MAP = Table(
    "DIMENSION_MAP",
    "gold",
    _columns(
        ("MAP_ID", LONG),
        ("FK_INVOICENO_STOCKCODE", STRING, "required"),
        ("FECHA_INVOICE", DATE),
        ("HORA_MINUTO", STRING),
        ("COUNTRY", STRING),
        ("STOCKCODE", STRING),
        ("INVOICE_DATE_ID", LONG),
        ("COUNTRY_ID", LONG),
        ("PRODUCT_ID", LONG),
        (MAP_LOAD, STRING),
    ),
    DIMENSION_KEY,
    primary_key="MAP_ID",
    partition_by=(MAP_LOAD,),
    bucket_by=DIMENSION_KEY,
)

#: What checks of declared keys found: a partition per checked table and load.
VIOLATIONS = Table(
    "CONSTRAINT_VIOLATIONS",
    "gold",
    _columns(
        ("CONSTRAINT_TYPE", STRING),
        ("COLUMN_NAME", STRING),
        ("KEY_VALUE", STRING),
        ("REASON", STRING),
        ("ROW_COUNT", LONG),
        ("TABLE_NAME", STRING),
        ("LOAD", STRING),
    ),
    "LOAD",
    partition_by=("TABLE_NAME", "LOAD"),
)

TABLES = {
    t.name: t
    for t in (
        INVOICE,
        INVOICE_SILVER,
        INVOICE_CANCELLED_SILVER,
        INVOICE_GOLD,
        INVOICE_CANCELLED_GOLD,
        INVOICE_DATE_DIM,
        COUNTRY_DIM,
        PRODUCT_DIM,
        DIMENSION_MAP,
        INVOICE_FACT_TABLE,
    )
}

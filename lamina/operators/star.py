"""Dimensions and the fact table around them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import load_stamp, natural_key
from lamina.operators.surrogate import keyed_ids
from lamina.schemas import (
    COUNTRY_DIM,
    DIMENSION_KEY,
    DIMENSION_MAP,
    FACT_KEY,
    INVOICE_DATE_DIM,
    INVOICE_FACT_TABLE,
    PRODUCT_DIM,
    Table,
)

LINE, KEY = "line", "key"


@dataclass(frozen=True)
class Dimension:
    """A dimension table and the silver column behind each of its attributes."""

    table: Table
    attributes: dict[str, str]

    @property
    def id_col(self) -> str:
        return self.table.primary_key


DATE = Dimension(INVOICE_DATE_DIM, {"FECHA_INVOICE": "FECHA_INVOICE", "HORA_MINUTO": "HORA_MINUTO_VARCHAR"})
COUNTRY = Dimension(COUNTRY_DIM, {"COUNTRY": "COUNTRY"})
PRODUCT = Dimension(PRODUCT_DIM, {"STOCKCODE": "STOCKCODE"})
DIMENSIONS = (DATE, COUNTRY, PRODUCT)


def dimension_rows(
    silver: DataFrame, dim: Dimension, load_ts: datetime | None = None, grain: str = LINE
) -> DataFrame:
    """Rows of ``dim`` without ids.

    ``grain="line"`` gives one row per silver line. ``grain="key"`` gives one row
    per natural key and attribute values; repeats collapse before the shuffle.
    """
    rows = silver.select(
        natural_key().alias(DIMENSION_KEY), *[F.col(src).alias(name) for name, src in dim.attributes.items()]
    )
    if checked_grain(grain) == KEY:
        rows = rows.distinct()
    return rows.withColumns(load_stamp(load_ts))


def fact_rows(silver: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """One row per silver line, without ids, with the attributes the dimensions are found by."""
    attributes = {name: src for dim in DIMENSIONS for name, src in dim.attributes.items()}
    return silver.select(
        natural_key().alias(FACT_KEY),
        "QUANTITY",
        "UNITPRICE",
        *[F.col(src).alias(name) for name, src in attributes.items()],
    ).withColumns(load_stamp(load_ts))


def map_rows(silver: DataFrame) -> DataFrame:
    """The attributes of all dimensions under each natural key, a row per line."""
    attributes = {name: src for dim in DIMENSIONS for name, src in dim.attributes.items()}
    return silver.select(natural_key().alias(DIMENSION_KEY), *[F.col(src).alias(name) for name, src in attributes.items()])


def with_dimension_ids(rows: DataFrame, first: int, parts: int) -> DataFrame:
    """Distinct ``map_rows`` with an id each and the ids of their dimension rows.

    A dimension row is a key with its attribute values; its id is the smallest id of the map rows
    that have them, so ids follow from the rows and no stored table is read. All windows lie
    within a key, which the rows are dealt by before repeats collapse: one shuffle. A row that lacks an attribute has no
    row in that dimension.
    """
    numbered = keyed_ids(rows, DIMENSION_MAP.primary_key, parts, first, [DIMENSION_KEY], once=True)
    ids = {}
    for dim in DIMENSIONS:
        same = Window.partitionBy(DIMENSION_KEY, *dim.attributes)
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dim.attributes])
        ids[dim.id_col] = F.when(complete, F.min(DIMENSION_MAP.primary_key).over(same))
    return numbered.withColumns(ids)


def dimension_of_map(map_loads: DataFrame, dim: Dimension) -> DataFrame:
    """The distinct rows of ``dim`` in whole loads of the map.

    The map row whose id a dimension row took stands for it, so these are found without a
    shuffle; only rows that lack an attribute, and so have no id, have to be compared.
    """
    rows = [dim.id_col, DIMENSION_KEY, *dim.attributes]
    own = map_loads.filter(F.col(dim.id_col) == F.col(DIMENSION_MAP.primary_key)).select(*rows)
    return own.union(map_loads.filter(F.col(dim.id_col).isNull()).select(*rows).distinct())


def mapped(facts: DataFrame, dimension_map: DataFrame, parts: int | None = None) -> DataFrame:
    """Fact rows with the three dimension ids, by one join on key and attribute values.

    Each line finds at most one row; a line that lacks an attribute is left out. The join has
    exchanges of its own on both sides, so adaptive execution can split a hot key. With ``parts``
    both sides are dealt by key alone into so many tasks, as the map is stored, and the attributes
    are compared within a key: for lines of which no key has very many.
    """
    matched = {FACT_KEY: DIMENSION_KEY} | {name: name for dim in DIMENSIONS for name in dim.attributes}
    ids = [dim.id_col for dim in DIMENSIONS]
    found = dimension_map.select(*ids, *[F.col(theirs).alias(f"_map_{ours}") for ours, theirs in matched.items()])
    same = {ours: F.col(ours) == F.col(f"_map_{ours}") for ours in matched}
    if parts:
        facts, found = facts.repartition(parts, FACT_KEY), found.repartition(parts, f"_map_{FACT_KEY}")
        # Not plain equations, so they are no keys of the join, which would deal both sides anew.
        same |= {ours: F.coalesce(equal, F.lit(False)) for ours, equal in same.items() if ours != FACT_KEY}
    joined = facts.join(found, list(same.values()), "inner")
    return joined.select(*[c for c in INVOICE_FACT_TABLE.schema.names if c in joined.columns])


def star(
    facts: DataFrame, dims: dict[str, DataFrame], grain: str = LINE, parts: int | None = None
) -> DataFrame:
    """Fact rows with the three dimension ids; a row without a match in any dimension is left out.

    ``grain="line"`` matches on the natural key alone, against line-grain
    dimensions: a key on k lines then gives k^4 rows. ``grain="key"`` matches on
    key and attribute values, against key-grain dimensions: each line finds at
    most one row per dimension, however often its key repeats. Every join has
    exchanges of its own there, so adaptive execution can split a hot key. With ``parts`` all
    sides are dealt by key alone into so many tasks, the facts once for all three joins, and
    the attributes are compared within a key: for lines of which no key has very many.
    """
    joined = facts.repartition(parts, FACT_KEY) if checked_grain(grain) == KEY and parts else facts
    for dim in DIMENSIONS:
        matched_on = [DIMENSION_KEY] if grain == LINE else [DIMENSION_KEY, *dim.attributes]
        found = dims[dim.table.name].select(dim.id_col, *[F.col(c).alias(f"_{dim.id_col}_{c}") for c in matched_on])
        ours = [FACT_KEY, *matched_on[1:]]
        same = [F.col(a) == F.col(f"_{dim.id_col}_{c}") for a, c in zip(ours, matched_on)]
        if grain == KEY and parts:
            found = found.repartition(parts, f"_{dim.id_col}_{DIMENSION_KEY}")
            same[1:] = [F.coalesce(equal, F.lit(False)) for equal in same[1:]]
        joined = joined.join(found, same, "inner")
    return joined.select(*[c for c in INVOICE_FACT_TABLE.schema.names if c in joined.columns])


def checked_grain(grain: str) -> str:
    if grain not in (LINE, KEY):
        raise ValueError(f"grain must be {LINE!r} or {KEY!r}, not {grain!r}")
    return grain

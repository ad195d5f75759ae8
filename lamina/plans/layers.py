"""Bronze, silver and gold loads. Layers hand over through stored tables only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import load_stamp, natural_key, now
from lamina.operators import cleaning
from lamina.operators.star import (
    DIMENSIONS,
    KEY,
    LINE,
    Dimension,
    checked_grain,
    dimension_of_map,
    dimension_rows,
    fact_rows,
    map_rows,
    mapped,
    star,
    with_dimension_ids,
)
from lamina.operators.surrogate import keyed_ids, sparse_ids
from lamina.schemas import (
    DIMENSION_KEY,
    DIMENSION_MAP,
    FACT_KEY,
    INVOICE,
    INVOICE_CANCELLED_GOLD,
    INVOICE_CANCELLED_SILVER,
    INVOICE_FACT_TABLE,
    INVOICE_GOLD,
    INVOICE_KEY,
    INVOICE_SILVER,
    LOAD_DATE,
    MAP_LOAD,
    TABLES,
    Table,
)
from lamina.session import make_active
from lamina.sources.tables import Load, Warehouse


#: Smallest and largest load key of an increment, by load key column.
Bounds = dict[str, tuple[str | None, str | None]]


def load_bronze(wh: Warehouse, incoming: DataFrame, load: str | None = None) -> Load:
    """Append unseen invoices as they are; new columns are added to the table.

    Lines without an invoice number would be unseen for ever: they are rejected and counted.
    """
    return wh.append_unseen(INVOICE, incoming, load=load, evolve=True)


def load_silver(wh: Warehouse, load_ts: datetime | None = None) -> list[Load]:
    """Clean and route stored bronze; append the invoices each silver table does not have."""
    routed = cleaning.route(cleaning.silver_typed(wh.scan(INVOICE), load_ts))
    return _side_by_side(wh, _silver_loads(wh, routed, load_ts))


def load_gold_invoices(
    wh: Warehouse,
    load_ts: datetime | None = None,
    silver: dict[str, DataFrame] | None = None,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> list[Load]:
    """Copy both silver tables to gold under a new load stamp."""
    return _side_by_side(wh, _gold_invoice_loads(wh, silver or _stored_silver(wh), load_ts, load, bounds))


def load_dimension(
    wh: Warehouse,
    dim: Dimension,
    silver: DataFrame,
    load_ts: datetime | None = None,
    grain: str = KEY,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> Load:
    """Lines of unseen keys first, then (at key grain) the few that are left without repeats.

    At key grain ids follow from the rows, so a load that is run again gives the same ones.
    """

    def numbered(rows: DataFrame, first: int, parts: int) -> DataFrame:
        if checked_grain(grain) == KEY:
            return keyed_ids(rows.distinct(), dim.id_col, parts, first)
        return sparse_ids(rows, dim.id_col, first)

    rows = dimension_rows(silver, dim, load_ts, LINE)
    return _append_unseen(wh, dim.table, rows, load_ts, load, bounds, numbered)


def load_dimension_map(
    wh: Warehouse, silver: DataFrame, load: str | None = None, bounds: Bounds | None = None
) -> Load:
    """The unseen natural keys with their attributes and the ids of all three dimensions.

    Ids follow from the rows and from where the last finished load ended, so a load that is
    run again gives the same ones. Each load is a partition.
    """
    load = load or uuid.uuid4().hex

    def numbered(rows: DataFrame, first: int, parts: int) -> DataFrame:
        return with_dimension_ids(rows, first, parts).withColumn(MAP_LOAD, F.lit(load))

    def collapsed(rows: DataFrame, first: int, parts: int) -> DataFrame:
        return numbered(rows.distinct(), first, parts)

    rows = map_rows(silver)
    return _append_unseen(wh, DIMENSION_MAP, rows, None, load, bounds, collapsed, prepare_dealt=numbered)


def load_mapped_dimension(wh: Warehouse, dim: Dimension, load_ts: datetime | None = None) -> Load:
    """Append what the map's loads brought since this dimension was loaded last.

    The ids tell how far that is: both grow by load. A load that was cut short after its
    append is found by its ids in the table, which is all or nothing, and only finished.
    """
    ledger, done = wh.ledger(dim.table), Load(dim.table.name, 0, 0, {})
    if not ledger.exists:
        ledger.create()
    since = ledger.next_id()
    pending = sorted((r for r in wh.ledger(DIMENSION_MAP).loads() if (r.NEXT_ID or 0) > since), key=lambda r: r.NEXT_ID)
    if not pending:
        return done
    first, after = pending[0].FIRST_ID, pending[-1].NEXT_ID
    if not wh.exists(dim.table) or wh.scan(dim.table).filter(F.col(dim.id_col).between(first, after - 1)).isEmpty():
        found = wh.scan(DIMENSION_MAP).filter(F.col(MAP_LOAD).isin([r.LOAD for r in pending]))
        rows = dimension_of_map(found, dim)
        done = wh.append(dim.table, rows.withColumns(load_stamp(load_ts)), load_ts)
    ledger.finish(pending[-1].LOAD, first, after)
    return done


def load_fact(
    wh: Warehouse,
    silver: DataFrame,
    load_ts: datetime | None = None,
    grain: str = KEY,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> Load:
    """Unseen lines first, then their dimension ids: the join only carries what will be stored.

    At key grain that is one join with the dimension map, of which only the loads in reach of
    the increment's keys are read; where no key is hot the lines are dealt as the map is stored. No final distinct: the ids make every row different, so it
    would shuffle everything and remove nothing. Ids come last, so every stored row has its
    own. A key whose lines find no dimension row stays unseen.
    """
    table = INVOICE_FACT_TABLE

    def by_map(rows: DataFrame, first: int, parts: int | None) -> DataFrame:
        reach = wh.ledger(DIMENSION_MAP).in_reach(*(bounds or {}).get(DIMENSION_KEY, (None, None)))
        found = mapped(rows, wh.scan(DIMENSION_MAP).filter(F.col(MAP_LOAD).isin(reach)), parts)
        return sparse_ids(found, table.primary_key, first)

    def starred(rows: DataFrame, first: int, parts: int) -> DataFrame:
        if grain == KEY:
            return by_map(rows, first, None)
        found = star(rows, {dim.table.name: wh.scan(dim.table) for dim in DIMENSIONS}, grain)
        return sparse_ids(found, table.primary_key, first)

    dealt = by_map if checked_grain(grain) == KEY else None
    return _append_unseen(
        wh, table, fact_rows(silver, load_ts), load_ts, load, bounds, starred, drops=True, prepare_dealt=dealt
    )


def load_gold(
    wh: Warehouse,
    load_ts: datetime | None = None,
    silver: dict[str, DataFrame] | None = None,
    grain: str = KEY,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> list[Load]:
    """Gold invoices and dimensions, then the fact that looks the dimensions up."""
    silver = silver or _stored_silver(wh)
    lines = silver[INVOICE_SILVER.name]
    invoices = _gold_invoice_loads(wh, silver, load_ts, load, bounds)
    if checked_grain(grain) == KEY:
        first = _side_by_side(wh, [*invoices, partial(load_dimension_map, wh, lines, load, bounds)])
        dims = [partial(load_mapped_dimension, wh, dim, load_ts) for dim in DIMENSIONS]
        last = _side_by_side(wh, [*dims, partial(load_fact, wh, lines, load_ts, grain, load, bounds)])
        return [*first, *last]
    dims = [partial(load_dimension, wh, dim, lines, load_ts, grain, load, bounds) for dim in DIMENSIONS]
    return [*_side_by_side(wh, [*invoices, *dims]), load_fact(wh, lines, load_ts, grain, load, bounds)]


def run_layers(
    wh: Warehouse, incoming: DataFrame, load_ts: datetime | None = None, grain: str = KEY
) -> list[Load]:
    """The whole run over stored tables. Running it again appends nothing."""
    load_ts = load_ts or now(wh.spark)
    return [load_bronze(wh, incoming), *load_silver(wh, load_ts), *load_gold(wh, load_ts, grain=grain)]


def run_increment(
    wh: Warehouse, bronze: DataFrame, load_ts: datetime | None = None, grain: str = KEY, load: str | None = None
) -> list[Load]:
    """The same run for one increment of new bronze rows.

    Every layer works on ``bronze`` instead of its whole stored input, so a run costs the
    increment and the stored keys of those loads that its range of keys meets. ``bronze`` must
    not change while this runs: pass a stored table. The bronze table comes last: until it
    has the invoices, an increment that was cut short is found new again, and the other
    tables drop what they already have. Under the same name ``load`` every table takes the
    increment once.
    """
    load_ts = load_ts or now(wh.spark)
    bounds = key_bounds(bronze)
    silver = cleaning.route(cleaning.silver_typed(bronze, load_ts))
    silver_loads = _side_by_side(wh, _silver_loads(wh, silver, load_ts, load, bounds))
    gold_loads = load_gold(wh, load_ts, silver, grain, load, bounds)
    return [*silver_loads, *gold_loads, _append_unseen(wh, INVOICE, bronze, None, load, bounds, evolve=True)]


def key_bounds(bronze: DataFrame) -> Bounds:
    """Smallest and largest invoice number and natural key of an increment: one row, two columns read."""
    keys = {INVOICE_KEY: F.col(INVOICE_KEY).cast("string"), DIMENSION_KEY: natural_key()}
    found = bronze.agg(*[f(c).alias(f"{f.__name__}_{n}") for n, c in keys.items() for f in (F.min, F.max)]).first()
    bounds = {n: (found[f"min_{n}"], found[f"max_{n}"]) for n in keys}
    return bounds | {FACT_KEY: bounds[DIMENSION_KEY]}


def resolved_facts(wh: Warehouse) -> DataFrame:
    """Stored facts with their dimension ids looked up again.

    Where a key does not repeat, its rows in all dimensions have one id: such facts are shuffled by
    it once for all three lookups, the others for each.
    """
    facts, ids = wh.scan(INVOICE_FACT_TABLE), [dim.id_col for dim in DIMENSIONS]
    one_id = reduce(lambda a, b: a & b, [F.col(ids[0]).eqNullSafe(F.col(c)) for c in ids[1:]])
    own = [INVOICE_FACT_TABLE.load_key, "QUANTITY", "UNITPRICE", LOAD_DATE]
    together = facts.filter(one_id).select(F.col(ids[0]).alias("_id"), *own)
    apart = facts.filter(~one_id).select(*[F.col(c).alias(f"_{c}") for c in ids], *own)
    for dim in DIMENSIONS:
        found = wh.scan(dim.table).select(dim.id_col, *dim.attributes)
        together = together.join(found, F.col("_id") == F.col(dim.id_col))
        apart = apart.join(found, F.col(f"_{dim.id_col}") == F.col(dim.id_col))
    attributes = [name for dim in DIMENSIONS for name in dim.attributes]
    columns = [INVOICE_FACT_TABLE.load_key, *attributes, "QUANTITY", "UNITPRICE", LOAD_DATE]
    return together.select(*columns).union(apart.select(*columns))


def _stored_silver(wh: Warehouse) -> dict[str, DataFrame]:
    return {t.name: wh.scan(t) for t in (INVOICE_SILVER, INVOICE_CANCELLED_SILVER)}


def _silver_loads(
    wh: Warehouse,
    routed: dict[str, DataFrame],
    load_ts: datetime | None,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> list[Callable[[], Load]]:
    return [partial(_append_unseen, wh, TABLES[name], rows, load_ts, load, bounds) for name, rows in routed.items()]


def _gold_invoice_loads(
    wh: Warehouse,
    silver: dict[str, DataFrame],
    load_ts: datetime | None,
    load: str | None = None,
    bounds: Bounds | None = None,
) -> list[Callable[[], Load]]:
    targets = {INVOICE_SILVER.name: INVOICE_GOLD, INVOICE_CANCELLED_SILVER.name: INVOICE_CANCELLED_GOLD}
    return [
        partial(_append_unseen, wh, target, cleaning.gold_invoice(silver[source], load_ts), load_ts, load, bounds)
        for source, target in targets.items()
    ]


def _side_by_side(wh: Warehouse, loads: list[Callable[[], Load]]) -> list[Load]:
    """Loads of different tables at the same time: one's last tasks and commit leave room for another."""
    with ThreadPoolExecutor(len(loads), initializer=make_active, initargs=(wh.spark,)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(wh.spark)(load)) for load in loads]]


def _append_unseen(
    wh: Warehouse,
    table: Table,
    rows: DataFrame,
    load_ts: datetime | None,
    load: str | None = None,
    bounds: Bounds | None = None,
    prepare: Callable[[DataFrame, int, int], DataFrame] | None = None,
    drops: bool = False,
    evolve: bool = False,
    prepare_dealt: Callable[[DataFrame, int, int], DataFrame] | None = None,
) -> Load:
    own = (bounds or {}).get(table.load_key, (None, None)) if table.name not in wh.load_keys else (None, None)
    return wh.append_unseen(table, rows, load_ts, load, evolve, own, prepare, drops, prepare_dealt)

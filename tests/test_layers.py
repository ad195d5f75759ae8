from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.operators.quality import orphans, repeated_keys
from lamina.operators.star import DIMENSIONS, KEY, LINE
from lamina.plans.layers import load_gold, load_silver, resolved_facts, run_increment, run_layers
from lamina.plans.queries import _stored_bronze, _warehouse
from lamina.schemas import INVOICE, INVOICE_FACT_TABLE, TABLES
from lamina.session import materialize
from lamina.sources.invoices import invoice_lines
from lamina.sources.tables import is_empty
from tests.conftest import rows

STAMP = datetime(2024, 1, 31, 12, 34)
LATER = datetime(2024, 2, 1, 0, 5)


@pytest.fixture(scope="module")
def loaded(spark, folder):
    """Early invoices in one run, all invoices in the next."""
    wh, lines = _warehouse(spark), invoice_lines(spark, folder)
    first = run_layers(wh, _stored_bronze(lines), STAMP)
    second = run_layers(wh, lines, LATER)
    return wh, first, second


def counts(wh):
    return {name: wh.scan(table).count() for name, table in TABLES.items()}


def test_rows_per_table(loaded):
    wh, first, second = loaded
    found = counts(wh)
    assert found["INVOICE"] == 6000
    assert found["INVOICE_SILVER"] == found["INVOICE_GOLD"] == 4226
    assert found["INVOICE_CANCELLED_SILVER"] == found["INVOICE_CANCELLED_GOLD"] == 1650
    assert found["INVOICE_FACT_TABLE"] == 4190
    for name in found:
        assert sum(load.stored for load in [*first, *second] if load.table == name) == found[name]


def test_rejected_dates_are_reported(loaded):
    _, first, second = loaded
    rejected = {load.table: load.rejected for load in second}
    assert rejected["INVOICE_DATE_DIM"] > 0
    assert sum(rejected.values()) == rejected["INVOICE_DATE_DIM"]
    assert all(load.rejected == 0 for load in first)


def test_loading_again_appends_nothing(loaded, spark, folder):
    wh, _, _ = loaded
    before = counts(wh)
    again = run_layers(wh, invoice_lines(spark, folder), LATER)
    assert sum(load.stored for load in again) == 0
    assert counts(wh) == before


def test_ids_are_unique_over_loads_and_resolve(loaded):
    wh, _, _ = loaded
    for dim in DIMENSIONS:
        assert is_empty(repeated_keys(wh.scan(dim.table), dim.id_col))
    facts = wh.scan(INVOICE_FACT_TABLE)
    assert is_empty(repeated_keys(facts, INVOICE_FACT_TABLE.primary_key))
    for column, (table, key) in INVOICE_FACT_TABLE.foreign_keys.items():
        assert is_empty(orphans(facts, column, wh.scan(TABLES[table]), key))


def test_load_stamps_tell_the_runs_apart(loaded):
    wh, _, _ = loaded
    stamps = wh.scan(TABLES["INVOICE_GOLD"]).select("FECHA_DE_CARGA", "HORA_DE_CARGA").distinct()
    assert rows(stamps) == [(STAMP.date(), "12:34"), (LATER.date(), "00:05")]


def test_line_grain_fans_out_like_the_joins(spark, folder, warehouse):
    lines = invoice_lines(spark, folder)
    run_layers(warehouse, lines, STAMP, grain=LINE)
    found = counts(warehouse)
    assert found["COUNTRY_DIM"] == found["PRODUCT_DIM"] == 4226
    assert found["INVOICE_DATE_DIM"] == 4190
    assert found["INVOICE_FACT_TABLE"] == 4568
    assert is_empty(repeated_keys(warehouse.scan(INVOICE_FACT_TABLE), "INVOICE_FACT_ID"))


def test_increments_give_the_same_tables_as_runs(loaded, spark, folder, warehouse):
    lines = materialize(invoice_lines(spark, folder), "increments")
    early = _stored_bronze(lines)
    late = lines.join(early.select("INVOICENO").distinct(), "INVOICENO", "left_anti").select(*lines.columns)
    run_increment(warehouse, early, STAMP)
    run_increment(warehouse, materialize(late, "late"), LATER)
    assert counts(warehouse) == counts(loaded[0])
    assert rows(resolved_facts(warehouse)) == rows(resolved_facts(loaded[0]))


def test_increment_cut_short_can_be_repeated(spark, folder, warehouse):
    """The run fails between silver and gold; the same increment is run again."""
    from lamina.operators import cleaning
    from lamina.plans import layers

    lines = materialize(invoice_lines(spark, folder), "cut-short")
    silver = cleaning.route(cleaning.silver_typed(lines, STAMP))
    for name, part in silver.items():
        layers._append_unseen(warehouse, TABLES[name], part, STAMP)
    layers.load_gold_invoices(warehouse, STAMP, silver)
    run_increment(warehouse, lines, STAMP)
    found = counts(warehouse)
    assert found["INVOICE_SILVER"] == found["INVOICE_GOLD"] == 4226
    assert found["INVOICE_FACT_TABLE"] == 4190
    assert found["INVOICE"] == 6000


def test_late_line_of_a_known_invoice_is_skipped(spark, folder, warehouse):
    """An invoice is loaded as a whole: what comes later under its number is not."""
    lines = invoice_lines(spark, folder)
    run_layers(warehouse, lines.filter("QUANTITY % 2 = 0"), STAMP)
    known = lines.filter("QUANTITY % 2 = 0").select("INVOICENO").distinct()
    run_layers(warehouse, lines, LATER)
    expected = lines.filter("QUANTITY % 2 = 0").count() + lines.join(known, "INVOICENO", "left_anti").count()
    assert warehouse.scan(INVOICE).count() == expected


def test_layers_can_be_loaded_one_by_one(spark, folder, warehouse):
    warehouse.append(INVOICE, invoice_lines(spark, folder))
    assert [load.stored for load in load_silver(warehouse, STAMP)] == [4226, 1650]
    assert load_gold(warehouse, STAMP, grain=KEY)[-1].stored == 4190


def test_stored_ids_fit_the_column(loaded):
    wh, _, _ = loaded
    top = wh.scan(INVOICE_FACT_TABLE).agg(F.max("INVOICE_FACT_ID")).first()[0]
    assert 4190 <= top + 1 < 2**63


def test_nothing_to_load(spark, warehouse):
    """No bronze table, then one without rows: every load reports zero."""
    assert [load.offered for load in load_silver(warehouse, STAMP)] == [0, 0]
    warehouse.create(INVOICE)
    assert {load.offered for load in run_layers(warehouse, warehouse.scan(INVOICE))} == {0}
    assert set(counts(warehouse).values()) == {0}

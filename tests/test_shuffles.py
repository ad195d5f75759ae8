"""What the loads need not shuffle."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from lamina.operators.star import DIMENSIONS, dimension_of_map, map_rows, with_dimension_ids
from lamina.plans import queries as plans
from lamina.plans.layers import load_bronze
from lamina.schemas import DIMENSION_KEY, INVOICE
from lamina.session import materialize
from lamina.sources import tables
from lamina.sources.invoices import invoice_lines
from lamina.sources.ledger import KEY, KeyLedger, key_of

STAMP = datetime(2024, 1, 31)


def exchanges_above(plan, scan):
    """How many exchanges the rows of the scan that matches ``scan`` go through."""
    above = []
    for line in plan.splitlines():
        depth = len(re.match(r"[\s:+\-*(0-9)]*", line).group())
        above = [(d, text) for d, text in above if d < depth]
        if re.search(scan, line):
            return sum("Exchange" in text for _, text in above)
        above.append((depth, line))
    raise AssertionError(f"no {scan} in the plan")


def test_lines_are_shuffled_for_product_and_order_only(spark, folder, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = invoice_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
    own = exchanges_above(plan, r"Scan parquet .*l_orderkey")
    spread = len(re.findall("REPARTITION_BY_NUM", plan))  # of a small input
    assert own - spread == 2


def test_a_query_joins_its_lines_once(spark, folder, monkeypatch):
    read, kept = [], []

    def counted(*given):
        read.append(given)
        return invoice_lines(*given)

    monkeypatch.setattr(plans, "invoice_lines", counted)
    monkeypatch.setattr(plans, "materialize", lambda df, *more: kept.append(more) or materialize(df, *more))
    for name in ("incr_bronze", "schema_diff", "schema_evolve_append"):
        read.clear(), kept.clear()
        plans.queries()[name](spark, folder)
        assert len(read) == len(kept) == 1, name


def lines(spark, *numbers):
    made = [(n, "p", "d", 1, "1/1/2010 8:00", 1.0, 1, "X") for n in numbers]
    return spark.createDataFrame(made, INVOICE.schema)


def test_loads_of_only_new_or_only_known_keys_look_none_up(spark, warehouse, monkeypatch):
    looked_up, look_up = [], tables.with_keys
    monkeypatch.setattr(tables, "with_keys", lambda *given: looked_up.append(1) or look_up(*given))

    def load(*numbers):
        looked_up.clear()
        done = load_bronze(warehouse, lines(spark, *numbers))
        return len(looked_up), done.offered, done.rejected, done.stored

    assert load("1", "1", "5", None) == (0, 4, 1, 3)
    assert load("1", "5", "5", None) == (0, 1, 1, 0)
    assert load("3", "4", None) == (0, 3, 1, 2)
    assert load("1", "6", "6", None) == (1, 3, 1, 2)
    assert load() == (0, 0, 0, 0)
    assert load(None) == (0, 1, 1, 0)
    stored = [r.INVOICENO for r in warehouse.scan(INVOICE).collect()]
    assert sorted(stored) == ["1", "1", "3", "4", "5", "6", "6"]


def test_ledger_counts_arrived_and_unseen_keys(spark, warehouse):
    ledger = KeyLedger(spark, warehouse.name(INVOICE))
    key = key_of([INVOICE.load_key]).alias(KEY)
    ledger.open("a", lines(spark, "1", "1", "2", None).select(key))
    assert ledger.share("a") == (2, 2)
    ledger.finish("a")
    ledger.open("b", lines(spark, "2", "3", "3", "4").select(key))
    assert ledger.share("b") == (3, 2)
    assert rows(ledger.opened("b")) == [("3",), ("4",)]


def test_dimension_rows_of_the_map_are_found_without_comparing_them(spark):
    silver = spark.createDataFrame(
        [("1", "p", "X", "8:00"), ("1", "p", "Y", "8:00"), ("1", "p", None, "8:00"), ("1", "p", "X", None), ("2", "p", "X", "8:00"), ("2", "p", "X", "8:00")],
        "INVOICENO string, STOCKCODE string, COUNTRY string, HORA_MINUTO_VARCHAR string",
    ).withColumn("FECHA_INVOICE", F.lit(STAMP.date()))
    found = with_dimension_ids(map_rows(silver), 100, 4).localCheckpoint()
    for dim in DIMENSIONS:
        got = dimension_of_map(found, dim)
        want = found.select(dim.id_col, DIMENSION_KEY, *dim.attributes).distinct()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

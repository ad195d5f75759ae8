"""Rows that are dealt by key once, hot keys, lookups without spare columns."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lamina.operators.star import DIMENSIONS, KEY as KEY_GRAIN
from lamina.operators.star import PRODUCT, dimension_rows, fact_rows, map_rows, mapped, star, with_dimension_ids
from lamina.plans.layers import load_dimension_map, load_fact, load_mapped_dimension, resolved_facts
from lamina.plans import queries as plans
from lamina.plans.queries import _shared_ids, _warehouse
from lamina.schemas import DIMENSION_KEY, DIMENSION_MAP, FACT_KEY, INVOICE_FACT_TABLE
from lamina.sources import tables
from lamina.sources.csv_files import read_csv_folder, write_csv_folder
from lamina.sources.ledger import KEY, KeyLedger
from test_shuffles import exchanges_above, lines

STAMP = datetime(2024, 1, 31)
DAY = "2010-12-01"
#: A key that comes with two countries, one that comes twice alike, one without a date.
FIRST = [("1", "a", "X", DAY, "08:26", 1), ("1", "a", "Y", DAY, "08:26", 2), ("2", "b", "X", DAY, "08:26", 3)]
LATER = [("2", "b", "Z", DAY, "08:26", 9), ("3", "c", "X", DAY, "09:00", 4), ("3", "c", "X", DAY, "09:00", 4),
         ("3", "c", "X", DAY, "10:00", 5), ("4", "d", "X", None, None, 6)]


@pytest.fixture
def large(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    )


def silver(spark, made):
    names = "INVOICENO string, STOCKCODE string, COUNTRY string, d string, HORA_MINUTO_VARCHAR string, q int"
    frame = spark.createDataFrame(made, names).withColumn("FECHA_INVOICE", F.col("d").cast("date"))
    return frame.withColumns({"QUANTITY": F.col("q").cast("decimal(10,2)"), "UNITPRICE": F.lit(1).cast("decimal(10,2)")})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, warehouse, df, name):
    path = f"{warehouse.root}/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_map_rows_are_shuffled_once(spark, warehouse, large):
    kept = stored(spark, warehouse, map_rows(silver(spark, FIRST)), "rows")
    assert exchanges_above(plan_of(with_dimension_ids(kept, 0, 4)), "Scan parquet") == 1
    ledger = KeyLedger(spark, warehouse.name(DIMENSION_MAP), buckets=4)
    key = F.col(DIMENSION_KEY).cast("string")
    ledger.open("a", spark.createDataFrame([("1_a",)], f"{KEY} string"))
    ledger.finish("a")
    ledger.open("b", kept.select(key.alias(KEY)))
    found = tables.unseen_rows(kept, key, ledger, "b", key.isNull(), dealt=True)
    assert exchanges_above(plan_of(with_dimension_ids(found, 0, ledger.buckets)), r"Scan parquet .*COUNTRY") == 1
    assert [r.STOCKCODE for r in found.collect()] == ["b"]


def test_looked_up_rows_carry_their_own_columns_only(spark, warehouse, large):
    kept = stored(spark, warehouse, lines(spark, "1", "2", None), "lines")
    wanted = spark.createDataFrame([("2",)], f"{KEY} string")
    found = tables.with_keys(kept, F.col("INVOICENO"), wanted, F.lit(False))
    assert "_key" not in plan_of(found) and found.columns == kept.columns
    assert sorted(str(r.INVOICENO) for r in found.collect()) == ["2", "None"]


def test_facts_are_dealt_as_the_map_is_stored(spark, warehouse, large):
    load_dimension_map(warehouse, silver(spark, FIRST + LATER))
    facts = stored(spark, warehouse, fact_rows(silver(spark, FIRST + LATER), STAMP), "facts")
    found = warehouse.scan(DIMENSION_MAP)
    dealt = mapped(facts, found, warehouse.ledger(DIMENSION_MAP).buckets)
    plan = plan_of(dealt)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert rows(dealt) == rows(mapped(facts, found)) and dealt.count() == 7


@pytest.mark.parametrize("hot", [False, True])
def test_hot_keys_change_no_result(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(tables, "HOT_ROWS", 0)
    wh = _warehouse(spark)
    for part in (FIRST, FIRST + LATER):
        done = load_dimension_map(wh, silver(spark, part))
        for dim in DIMENSIONS:
            load_mapped_dimension(wh, dim, STAMP)
        load_fact(wh, silver(spark, part), STAMP)
    assert done.stored == 3  # of key 3_c two times of day, of key 4_d one without
    assert wh.scan(DIMENSION_MAP).count() == 6
    got = rows(resolved_facts(wh).select(FACT_KEY, "HORA_MINUTO", "COUNTRY", F.col("QUANTITY").cast("int")))
    want = [(f"{i}_{p}", at, c, q) for i, p, c, d, at, q in [*FIRST, *LATER[1:]] if d]
    assert got == sorted(want)


def test_most_rows_of_a_key_are_counted(spark, warehouse):
    ledger = KeyLedger(spark, warehouse.name(DIMENSION_MAP))
    for load, keys, most in (("a", "xxy", 2), ("b", "x---", 3), ("c", "", 0)):
        ledger.open(load, spark.createDataFrame([(k if k != "-" else None,) for k in keys], f"{KEY} string"))
        assert ledger.most(load) == most
        ledger.finish(load)
    assert rows(ledger.stored().groupBy(KEY).count()) == [("x", 1), ("y", 1)]


def test_facts_of_one_id_are_shuffled_once(spark, warehouse, large):
    load_dimension_map(warehouse, silver(spark, FIRST))
    for dim in DIMENSIONS:
        load_mapped_dimension(warehouse, dim, STAMP)
    load_fact(warehouse, silver(spark, FIRST), STAMP)
    ids = [dim.id_col for dim in DIMENSIONS]
    assert {len({r[c] for c in ids}) for r in warehouse.scan(INVOICE_FACT_TABLE).collect()} == {1, 2}
    found = resolved_facts(warehouse)
    assert exchanges_above(plan_of(found), r"Scan parquet .*invoice_fact_table") == 1
    assert sorted((r.COUNTRY, r.STOCKCODE) for r in found.collect()) == [("X", "a"), ("X", "b"), ("Y", "a")]


def test_ids_of_several_rows_are_found(spark):
    made = [(1, "k", "p"), (1, "k", "p"), (2, "k", "p"), (2, "l", "p"), (3, "m", None), (3, "m", None), (4, "n", "p"), (None, "o", "p"), (None, "q", "p")]
    found = spark.createDataFrame(made, f"PRODUCT_ID long, {DIMENSION_KEY} string, STOCKCODE string")
    assert rows(_shared_ids(found, PRODUCT)) == [(1, True), (2, False), (3, True)]


def test_csv_folders_are_compressed(spark, warehouse):
    path = f"{warehouse.root}/csv"
    write_csv_folder(lines(spark, "1", "2"), path)
    found = read_csv_folder(spark, path)
    assert all(name.endswith(".csv.gz") for name in found.inputFiles())
    assert rows(found) == rows(lines(spark, "1", "2"))


def test_star_facts_are_shuffled_once(spark, warehouse, large):
    made = silver(spark, FIRST + LATER)
    facts = stored(spark, warehouse, fact_rows(made, STAMP), "facts")
    dims = {d.table.name: dimension_rows(made, d, STAMP, KEY_GRAIN).withColumn(d.id_col, F.lit(1)) for d in DIMENSIONS}
    dealt = star(facts, dims, KEY_GRAIN, 4)
    assert exchanges_above(plan_of(dealt), "Scan parquet") == 1
    assert rows(dealt) == rows(star(facts, dims, KEY_GRAIN)) and dealt.count() == 7


def test_lines_of_a_hot_key_are_not_dealt(spark, monkeypatch):
    made = silver(spark, FIRST)
    assert plans._parts(made) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(plans, "HOT_ROWS", 1)
    assert plans._parts(made) is None and plans._parts(made.limit(0)) is not None

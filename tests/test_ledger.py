"""Keys of finished loads: plans, ranges, recovery, compaction, ids."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.operators.star import COUNTRY, DIMENSIONS, fact_rows, map_rows, mapped, with_dimension_ids
from lamina.plans.layers import (
    key_bounds,
    load_bronze,
    load_dimension,
    load_dimension_map,
    load_mapped_dimension,
    run_layers,
)
from lamina.plans.queries import _silver, _warehouse
from lamina.schemas import COUNTRY_DIM, DIMENSION_MAP, INVOICE, INVOICE_FACT_TABLE
from lamina.sources import tables
from lamina.sources.invoices import invoice_lines
from lamina.sources.ledger import KEY, KeyLedger
from lamina.sources.tables import Warehouse
from tests.conftest import final_plan, rows

STAMP = datetime(2024, 1, 31, 12, 34)


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], f"{KEY} string")


@pytest.fixture
def ledger(spark, warehouse):
    made = KeyLedger(spark, f"{warehouse.database('bronze')}.T", buckets=4)
    for load, first, last in (("jan", 100, 200), ("feb", 200, 300), ("mar", 300, 400)):
        made.open(load, keys(spark, [f"{i}" for i in range(first, last)]))
        made.finish(load)
    return made


def unseen(ledger, spark, values, *bounds):
    return {r[0] for r in ledger.unseen(keys(spark, values), *bounds).collect()}


def test_unseen_keys(ledger, spark):
    assert unseen(ledger, spark, ["150", "150", "399", "400", "x", None]) == {"400", "x"}
    assert KeyLedger(spark, f"{ledger.name}_other").unseen(keys(spark, ["a", "a"])).count() == 1


def test_stored_side_is_not_exchanged(ledger, spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = final_plan(ledger.unseen(keys(spark, ["150", "500"])))
    plan = plan[: plan.index("Initial Plan")]
    stored = plan[plan.index("LeftOuter") :].rsplit("Sort", 1)[1]
    assert "FileScan" in stored and "Exchange" not in stored and "Bucketed: true" in stored
    assert "SelectedBucketsCount: 4 out of 4" in stored
    with pytest.raises(ValueError, match="finished"):
        ledger.open("feb", keys(spark, ["1"]))


def test_only_loads_in_reach_are_read(ledger, spark):
    files = {name: len(ledger.stored(*b).inputFiles()) for name, b in
             {"all": (None, None), "one": ("310", "320"), "two": ("199", "200")}.items()}
    assert 0 < files["one"] < files["two"] < files["all"]
    assert ledger.stored("400", "999") is None
    outside = ledger.unseen(keys(spark, ["500"]), "500", "500")
    assert "FileScan" not in final_plan(outside) and outside.count() == 1
    assert unseen(ledger, spark, ["199", "200", "2"], "199", "200") == {"2"}


def test_load_without_its_row_is_not_seen_and_settled(ledger, spark):
    ledger.open("apr", keys(spark, ["400", "401"]))
    ledger.open("may", keys(spark, ["500"]))
    assert unseen(ledger, spark, ["400", "500"]) == {"400", "500"}
    assert not ledger.finished("apr") and sorted(ledger.open_loads()) == ["apr", "may"]
    target = keys(spark, ["399", "401"]).withColumn("id", F.lit(7).cast("long"))
    assert ledger.recover(target, F.col(KEY), "id") == {"apr": True, "may": False}
    assert unseen(ledger, spark, ["400", "500"]) == {"500"} and ledger.open_loads() == []
    assert ledger.next_id() == 8


def test_compaction_keeps_keys_and_leaves_one_load(ledger, spark):
    files = len(ledger.stored().inputFiles())
    ledger.compact("all")
    assert [row.LOAD for row in ledger.loads()] == ["all"]
    assert len(ledger.stored().inputFiles()) < files
    assert unseen(ledger, spark, ["100", "399", "400"]) == {"400"}
    ledger.compact("again")
    assert [row.LOAD for row in ledger.loads()] == ["all"] and ledger.open_loads() == []


def test_hot_key_of_an_increment_is_split(spark, folder, tmp_path, settings, ledger):
    """A third of all rows carry one new key."""
    hot = F.when(F.col("l_linenumber") <= 2, "hot").otherwise(F.col("l_orderkey").cast("string"))
    path = str(tmp_path / "hot")
    spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("k", hot).repartition(16).write.parquet(path)
    incoming = spark.read.parquet(path)
    ledger.open("hot", incoming.select(F.col("k").alias(KEY)))
    settings(
        spark__sql__shuffle__partitions="64",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    found = tables.with_keys(incoming, F.col("k"), ledger.opened("hot"), F.lit(False))
    assert "skew=true" in final_plan(found)
    seen = keys(spark, [str(i) for i in range(100, 400)])
    assert found.count() == incoming.join(seen, F.col("k") == F.col(KEY), "left_anti").count()


def test_table_without_a_ledger_is_adopted(spark, folder, warehouse):
    lines = invoice_lines(spark, folder)
    warehouse.append(INVOICE, lines.filter("INVOICENO like '1%'"))
    load_bronze(warehouse, lines)
    assert warehouse.scan(INVOICE).count() == lines.count()
    assert "adopted" in {row.LOAD for row in warehouse.ledger(INVOICE).loads()}


def test_late_lines_with_a_wider_load_key(spark, folder):
    plain = _warehouse(spark)
    wh = Warehouse(spark, plain.root + "-late", plain.prefix + "late", load_keys={"INVOICE": ["INVOICENO", "STOCKCODE"]})
    lines = invoice_lines(spark, folder).filter("STOCKCODE is not null").dropDuplicates(["INVOICENO", "STOCKCODE"])
    for _ in range(2):
        load_bronze(wh, lines.filter("QUANTITY % 2 = 0"))
        load_bronze(wh, lines)
    assert wh.scan(INVOICE).count() == lines.count()


@pytest.mark.parametrize("step", ["before the append", "after the append"])
def test_killed_load_leaves_neither_half_nor_double_rows(spark, folder, warehouse, monkeypatch, step):
    lines = _silver(spark, folder)
    append, finish = Warehouse.append, KeyLedger.finish

    def killed(*_, **__):
        raise RuntimeError("lost the driver here")

    load_dimension(warehouse, COUNTRY, lines.filter("INVOICENO like '1%'"), STAMP)
    monkeypatch.setattr(Warehouse if step.startswith("before") else KeyLedger, "append" if step.startswith("before") else "finish", killed)
    with pytest.raises(RuntimeError, match="lost the driver"):
        load_dimension(warehouse, COUNTRY, lines, STAMP, load="again")
    monkeypatch.setattr(Warehouse, "append", append)
    monkeypatch.setattr(KeyLedger, "finish", finish)
    load_dimension(warehouse, COUNTRY, lines, STAMP, load="again")
    load_dimension(warehouse, COUNTRY, lines, STAMP, load="again")
    stored = warehouse.scan(COUNTRY_DIM)
    expected = lines.selectExpr("INVOICENO || '_' || STOCKCODE", "COUNTRY").distinct()
    assert rows(stored.select("FK_INVOICENO_STOCKCODE", "COUNTRY")) == rows(expected)
    assert stored.select("COUNTRY_ID").distinct().count() == stored.count()


def test_repeated_batch_gets_the_same_ids(spark, folder, warehouse, monkeypatch):
    lines = _silver(spark, folder)
    load_dimension(warehouse, COUNTRY, lines.filter("INVOICENO like '1%'"), STAMP)
    seen = []
    append = Warehouse.append

    def kept(self, table, df, *rest, **more):
        seen.append(rows(df.select("COUNTRY_ID", "FK_INVOICENO_STOCKCODE")))
        if len(seen) == 1:
            raise RuntimeError("lost the driver here")
        return append(self, table, df, *rest, **more)

    monkeypatch.setattr(Warehouse, "append", kept)
    with pytest.raises(RuntimeError):
        load_dimension(warehouse, COUNTRY, lines, STAMP, load="again")
    load_dimension(warehouse, COUNTRY, lines, STAMP, load="again")
    assert seen[0] == seen[1] and seen[0]


def test_ids_lie_in_the_range_of_their_load(spark, folder, warehouse):
    lines = invoice_lines(spark, folder)
    for part in ("INVOICENO like '1%'", "INVOICENO like '2%'", "true"):
        run_layers(warehouse, lines.filter(part), STAMP)
    for table in [dim.table for dim in DIMENSIONS] + [INVOICE_FACT_TABLE]:
        leased = [(r.FIRST_ID, r.NEXT_ID) for r in warehouse.ledger(table).loads()]
        assert len(leased) == 3 and all(a < b for a, b in leased)
        assert [b for _, b in sorted(leased)][:-1] == [a for a, _ in sorted(leased)][1:]
        top = warehouse.scan(table).agg(F.max(table.primary_key)).first()[0]
        assert top < max(b for _, b in leased)


def test_fact_key_without_a_dimension_row_stays_unseen(spark, folder, warehouse):
    from lamina.plans.layers import load_fact

    lines = _silver(spark, folder)
    assert load_fact(warehouse, lines, STAMP).stored == 0
    load_dimension_map(warehouse, lines)
    assert load_fact(warehouse, lines, STAMP).stored == 4190


def test_fact_needs_one_join_with_the_map(spark, folder, warehouse, settings):
    lines = _silver(spark, folder)
    load_dimension_map(warehouse, lines)
    path = warehouse.root + "/lines"
    lines.write.parquet(path)
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    facts = mapped(fact_rows(spark.read.parquet(path), STAMP), warehouse.scan(DIMENSION_MAP))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Exchange") == 2
    assert facts.count() == 4190


def test_map_ids_are_one_per_dimension_row(spark):
    day = "2010-12-01"
    lines = [("1", "a", "X", day, "08:26"), ("1", "a", "Y", day, "08:26"), ("1", "a", "Y", day, "08:26"),
             ("1", "a", "X", day, "08:27"), ("2", "a", "X", None, None)]
    frame = spark.createDataFrame(lines, "INVOICENO string, STOCKCODE string, COUNTRY string, d string, HORA_MINUTO_VARCHAR string")
    frame = frame.withColumn("FECHA_INVOICE", F.col("d").cast("date"))
    found = with_dimension_ids(map_rows(frame), 100, 4)
    got = found.collect()
    assert len(got) == 4 == len({r.MAP_ID for r in got}) and min(r.MAP_ID for r in got) >= 100
    for dim in DIMENSIONS:
        values = {(r.FK_INVOICENO_STOCKCODE, *[r[c] for c in dim.attributes]): set() for r in got}
        for r in got:
            values[r.FK_INVOICENO_STOCKCODE, *[r[c] for c in dim.attributes]].add(r[dim.id_col])
        assert all(len(ids) == 1 for ids in values.values())
        filled = [next(iter(ids)) for key, ids in values.items() if None not in key]
        assert len(set(filled)) == len(filled) and all(v is not None for v in filled)
    assert [r.INVOICE_DATE_ID for r in got if r.FECHA_INVOICE is None] == [None]
    assert rows(with_dimension_ids(map_rows(frame.repartition(3)), 100, 4)) == rows(found)


@pytest.mark.parametrize("step", ["before", "after"])
def test_dimension_cut_short_is_finished_once(spark, folder, warehouse, monkeypatch, step):
    lines = _silver(spark, folder)
    load_dimension_map(warehouse, lines.filter("INVOICENO like '1%'"))
    load_mapped_dimension(warehouse, COUNTRY, STAMP)
    load_dimension_map(warehouse, lines)
    with monkeypatch.context() as patch:

        def killed(*_, **__):
            raise RuntimeError("lost the driver here")

        patch.setattr(*((Warehouse, "append") if step == "before" else (KeyLedger, "finish")), killed)
        with pytest.raises(RuntimeError, match="lost the driver"):
            load_mapped_dimension(warehouse, COUNTRY, STAMP)
    for _ in range(2):
        load_mapped_dimension(warehouse, COUNTRY, STAMP)
    stored = warehouse.scan(COUNTRY_DIM).select("FK_INVOICENO_STOCKCODE", "COUNTRY")
    assert rows(stored) == rows(lines.selectExpr("INVOICENO || '_' || STOCKCODE", "COUNTRY").distinct())


def test_bounds_of_an_increment(spark):
    frame = spark.createDataFrame([("2", "b"), ("10", "a"), (None, "c"), ("3", None)], "INVOICENO string, STOCKCODE string")
    bounds = key_bounds(frame)
    assert bounds["INVOICENO"] == ("10", "3") and bounds["FK_INVOICENO_STOCKCODE"] == ("10_a", "2_b")

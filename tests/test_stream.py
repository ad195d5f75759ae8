import os
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lamina.plans.layers import resolved_facts
from lamina.plans.queries import _stored_bronze
from lamina.operators.incremental import new_rows
from lamina.schemas import INVOICE, TABLES
from lamina.session import fresh_path
from lamina.sources.csv_files import write_csv_folder
from lamina.sources.invoices import invoice_lines
from lamina.streaming import arrivals

STAMP = datetime(2024, 1, 31, 12, 34)


def test_files_go_through_all_layers_once(spark, folder, warehouse, monkeypatch):
    """Two deliveries; the second batch fails once after silver and is repeated by a new query."""
    lines = invoice_lines(spark, folder)
    early = _stored_bronze(lines)
    inbox, checkpoint = fresh_path(spark, "inbox"), fresh_path(spark, "checkpoint")

    def take():
        stream = arrivals.arriving_lines(spark, f"{inbox}/*")
        return arrivals.start_incremental_load(warehouse, stream, checkpoint, STAMP, once=True)

    write_csv_folder(early, f"{inbox}/first")
    take().awaitTermination()
    first = warehouse.scan(INVOICE).count()
    assert first == early.count()

    write_csv_folder(new_rows(lines, early, "INVOICENO"), f"{inbox}/second")
    whole_run = arrivals.run_increment

    def broken(wh, bronze, load_ts, grain, load):
        from lamina.operators import cleaning
        from lamina.plans.layers import _append_unseen

        for name, part in cleaning.route(cleaning.silver_typed(bronze, load_ts)).items():
            _append_unseen(wh, TABLES[name], part, load_ts)
        raise RuntimeError("lost the driver here")

    monkeypatch.setattr(arrivals, "run_increment", broken)
    query = take()
    try:
        query.awaitTermination()
    except Exception as error:
        assert "lost the driver here" in str(error)
    else:
        raise AssertionError("the batch should have failed")
    assert warehouse.scan(INVOICE).count() == first

    monkeypatch.setattr(arrivals, "run_increment", whole_run)
    take().awaitTermination()
    assert warehouse.scan(INVOICE).count() == 6000
    assert warehouse.scan(TABLES["INVOICE_SILVER"]).count() == 4226
    assert warehouse.scan(TABLES["INVOICE_CANCELLED_GOLD"]).count() == 1650
    assert resolved_facts(warehouse).count() == 4190

    take().awaitTermination()
    assert warehouse.scan(INVOICE).count() == 6000


def test_one_invoice_in_two_files(spark, folder, warehouse):
    """Lines of one invoice that arrive together are all stored, and one staged copy stays at most."""
    lines = invoice_lines(spark, folder).filter("INVOICENO like '1%'").cache()
    inbox, checkpoint = fresh_path(spark, "inbox"), fresh_path(spark, "checkpoint")
    for half in (0, 1):
        write_csv_folder(lines.filter(f"xxhash64(STOCKCODE, QUANTITY) % 2 in ({half}, {-half})"), f"{inbox}/{half}")
    stream = arrivals.arriving_lines(spark, f"{inbox}/*")
    arrivals.start_incremental_load(warehouse, stream, checkpoint, STAMP, once=True).awaitTermination()
    assert warehouse.scan(INVOICE).count() == lines.count()
    assert not [f for f in os.listdir(f"{checkpoint}/staged") if f.startswith("batch")]


def test_a_repeated_batch_is_not_read_again(spark, folder, warehouse, monkeypatch):
    """A cut-short batch is taken up from its copy; the next one has a copy of its own."""
    lines = invoice_lines(spark, folder).filter("INVOICENO like '1%'")
    inbox, checkpoint = fresh_path(spark, "inbox"), fresh_path(spark, "checkpoint")
    whole_run, seen = arrivals.run_increment, []

    def take():
        stream = arrivals.arriving_lines(spark, f"{inbox}/*")
        query = arrivals.start_incremental_load(warehouse, stream, checkpoint, STAMP, once=True)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            assert "lost here" in str(error)
        return query.recentProgress

    def broken(wh, bronze, *given):
        seen.append((bronze.count(), bronze.inputFiles()))
        if len(seen) == 1:
            raise RuntimeError("lost here")
        whole_run(wh, bronze, *given)

    monkeypatch.setattr(arrivals, "run_increment", broken)
    write_csv_folder(lines, f"{inbox}/first")
    take()
    assert sum(p["numInputRows"] for p in take()) == 0
    assert seen[0] == seen[1] and seen[0][0] == lines.count()
    assert not os.listdir(f"{checkpoint}/staged")
    write_csv_folder(lines.withColumn("INVOICENO", F.concat("INVOICENO", F.lit("0000"))), f"{inbox}/second")
    take()
    assert seen[2][0] == lines.count() and not set(seen[2][1]) & set(seen[0][1])
    assert warehouse.scan(INVOICE).count() == 2 * lines.count()


def test_an_unfinished_copy_of_a_batch_is_written_anew(spark, tmp_path):
    path, (few, more, wider) = f"{tmp_path}/staged", (
        spark.range(2).selectExpr("id"), spark.range(3).selectExpr("id"), spark.range(4).selectExpr("id", "id as n")
    )
    assert arrivals._staged(spark, few, path, 0).count() == 2
    assert arrivals._staged(spark, more, path, 0).count() == 2
    os.remove(f"{path}/0/_SUCCESS")
    assert arrivals._staged(spark, more, path, 0).count() == 3
    assert arrivals._staged(spark, wider, path, 0).count() == 4
    assert arrivals._staged(spark, few, path, 1).count() == 2
    assert os.listdir(path) == ["1"]

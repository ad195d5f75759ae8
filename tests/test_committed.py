import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.plans.layers import load_bronze, resolved_facts, run_layers
from lamina.plans.queries import _stored_bronze
from lamina.schemas import INVOICE, INVOICE_FACT_TABLE, INVOICE_GOLD
from lamina.session import fresh_path
from lamina.sources.committed import FORMAT, CommittedTables
from lamina.sources.invoices import invoice_lines
from lamina.sources.tables import ConnectorWarehouse, append_connector, scan_connector
from tests.conftest import rows

STAMP = datetime(2024, 1, 31, 12, 34)


@pytest.fixture
def options(spark):
    spark.dataSource.register(CommittedTables)
    return {"folder": fresh_path(spark, "connector")}


def files_of(options, table):
    found = [os.path.join(at, f) for at, _, names in os.walk(f"{options['folder']}/{table}") for f in names]
    return [f for f in found if f.endswith((".parquet", ".json", ".waiting"))]


def test_appends_add_up_and_later_columns_are_null_before(spark, options):
    first = spark.range(5, numPartitions=3).select("id", F.expr("cast(id as decimal(10,2))").alias("d"))
    append_connector(first, FORMAT, options, "t")
    more = spark.range(5, 7).select("id", F.lit(None).cast("decimal(10,2)").alias("d"), F.lit("ü").alias("text"))
    append_connector(more, FORMAT, options, "t")
    found = scan_connector(spark, FORMAT, options, "t")
    assert found.columns == ["id", "d", "text"]
    values = [tuple(r) for r in found.orderBy("id").collect()]
    assert values == [(i, i, None) for i in range(5)] + [(5, None, "ü"), (6, None, "ü")]


def test_a_failed_task_leaves_no_row(spark, options):
    append_connector(spark.range(10), FORMAT, options, "t")
    before = files_of(options, "t")
    broken = spark.range(0, 1000, numPartitions=4).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        append_connector(broken, FORMAT, options, "t")
    assert scan_connector(spark, FORMAT, options, "t").count() == 10
    assert files_of(options, "t") == before
    append_connector(spark.range(10, 20), FORMAT, options, "t")
    assert rows(scan_connector(spark, FORMAT, options, "t")) == [(i,) for i in range(20)]


def test_tables_without_rows(spark, options):
    assert scan_connector(spark, FORMAT, options, "none").columns == []
    append_connector(spark.range(0), FORMAT, options, "empty")
    found = scan_connector(spark, FORMAT, options, "empty")
    assert (found.columns, found.count()) == (["id"], 0)
    with pytest.raises(Exception, match="only take appends"):
        spark.range(3).write.format(FORMAT).options(**options, dbtable="empty").mode("overwrite").save()


def test_layers_behind_a_connector(spark, folder, warehouse, options):
    """Two whole runs, the second with a column more, give what the catalog gives; a third adds nothing."""
    wh = ConnectorWarehouse(spark, warehouse.root, FORMAT, options, prefix=warehouse.prefix)
    assert not wh.exists(INVOICE) and wh.scan(INVOICE).count() == 0
    lines = invoice_lines(spark, folder, ["LINENUMBER"])
    run_layers(wh, _stored_bronze(invoice_lines(spark, folder)), STAMP)
    run_layers(wh, lines, STAMP)
    assert wh.scan(INVOICE).count() == lines.count()
    assert wh.scan(INVOICE).columns[-1] == "LINENUMBER"
    assert wh.scan(INVOICE_GOLD).count() == 4226
    facts = wh.scan(INVOICE_FACT_TABLE)
    assert facts.count() == facts.select("INVOICE_FACT_ID").distinct().count() == resolved_facts(wh).count() == 4190
    done = load_bronze(wh, lines)
    assert done.stored == 0 and wh.scan(INVOICE).count() == lines.count()

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from lamina import session as session_module
from lamina.plans.layers import load_bronze
from lamina.schemas import COUNTRY_DIM, INVOICE, INVOICE_SILVER, TABLES
from lamina.session import fresh_path, materialize, shared_folder
from lamina.sources.csv_files import read_csv_folder, write_csv_folder
from lamina.sources.invoices import invoice_lines, use_all_cores
from lamina.sources.tables import append_connector, is_empty, scan_connector
from tests.conftest import rows

STAMP = datetime(2024, 1, 31, 12, 34)


def country(spark, *values):
    return spark.createDataFrame(
        [(i, f"{i}_a", v, STAMP.date(), "12:34") for i, v in enumerate(values)], COUNTRY_DIM.schema
    )


def test_missing_table_has_its_declared_columns_and_no_rows(warehouse):
    for table in TABLES.values():
        assert not warehouse.exists(table)
        scanned = warehouse.scan(table)
        assert scanned.columns == table.schema.names
        assert [f.dataType for f in scanned.schema] == [f.dataType for f in table.schema]
    assert is_empty(warehouse.scan(INVOICE))


def test_created_table_keeps_types_and_column_order(warehouse):
    for table in TABLES.values():
        warehouse.create(table)
        warehouse.create(table)
        stored = warehouse.scan(table)
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in table.schema]


def test_append_rejects_and_reports(spark, warehouse):
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in COUNTRY_DIM.schema])
    data = [(1, "1_a", "X", STAMP.date(), "12:34"), (2, None, "Y", STAMP.date(), "12:34"), (3, "3_a", None, None, None)]
    load = warehouse.append(COUNTRY_DIM, spark.createDataFrame(data, schema))
    assert (load.table, load.offered, load.rejected, load.stored) == ("COUNTRY_DIM", 3, 2, 1)
    assert load.nulls["COUNTRY"] == 1
    assert rows(warehouse.scan(COUNTRY_DIM)) == [(1, "1_a", "X", date(2024, 1, 31), "12:34")]


def test_named_and_computed_partitions_store_the_same(spark, warehouse):
    warehouse.append(COUNTRY_DIM, country(spark, "X", "Y"), STAMP)
    warehouse.append(COUNTRY_DIM, country(spark, "X", "Y"))
    stored = rows(warehouse.scan(COUNTRY_DIM))
    assert len(stored) == 4
    assert set(stored) == set(rows(country(spark, "X", "Y")))


def test_quantities_round_at_the_table(spark, warehouse):
    line = ("1", "a", "d", Decimal("2.50"), Decimal("1.00"), "X", None, None, STAMP.date(), "12:34")
    schema = T.StructType(
        [
            T.StructField(f.name, T.DecimalType(10, 2) if f.name == "QUANTITY" else f.dataType)
            for f in INVOICE_SILVER.schema
        ]
    )
    warehouse.append(INVOICE_SILVER, spark.createDataFrame([line], schema), STAMP)
    assert warehouse.scan(INVOICE_SILVER).first().QUANTITY == Decimal("3")


def test_created_but_empty_table_takes_rows(spark, folder, warehouse):
    warehouse.create(INVOICE)
    load = load_bronze(warehouse, invoice_lines(spark, folder))
    assert load.stored == warehouse.scan(INVOICE).count() == 6000


def test_a_delivery_without_a_column_is_filled_with_null(spark, folder, warehouse):
    lines = invoice_lines(spark, folder)
    load_bronze(warehouse, lines.filter("CUSTOMERID % 2 = 0"))
    load_bronze(warehouse, lines.drop("COUNTRY"))
    stored = warehouse.scan(INVOICE)
    assert stored.columns == INVOICE.schema.names
    assert stored.filter("CUSTOMERID % 2 = 1 and COUNTRY is not null").count() == 0
    assert stored.count() == 6000


def test_tables_behind_a_connector(spark, tmp_path):
    options = {"path": str(tmp_path / "t")}
    append_connector(spark.range(3), "parquet", options)
    append_connector(spark.range(2), "parquet", options)
    assert scan_connector(spark, "parquet", options).count() == 5


def test_csv_folder(spark, folder, tmp_path):
    path = str(tmp_path / "csv")
    lines = invoice_lines(spark, folder)
    write_csv_folder(lines, path)
    assert rows_as_text(read_csv_folder(spark, path)) == rows_as_text(lines)
    inferred = read_csv_folder(spark, path, schema=None)
    assert {f.name: f.dataType.simpleString() for f in inferred.schema}["UNITPRICE"] == "double"
    assert inferred.count() == 6000


def rows_as_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_value_that_does_not_fit_the_schema_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "INVOICENO,STOCKCODE,DESCRIPTION,QUANTITY,INVOICEDATE,UNITPRICE,CUSTOMERID,COUNTRY\n"
        "1,a,d,two,12/1/2010 8:26,1.5,7,X\n"
    )
    row = read_csv_folder(spark, str(tmp_path)).first()
    assert (row.INVOICENO, row.QUANTITY, row.UNITPRICE) == ("1", None, 1.5)


def test_written_frame_has_no_lineage(spark, folder):
    lines = invoice_lines(spark, folder)
    stored = materialize(lines, "test")
    assert rows_as_text(stored) == rows_as_text(lines)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lineitem" not in plan


def test_only_a_small_scan_is_spread(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    assert use_all_cores(orders, "o_orderkey").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert use_all_cores(many, "id") is many


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.value


class _Session:
    def __init__(self, folder, master):
        self.conf = _Conf(folder)
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_is_the_configured_one(monkeypatch, tmp_path):
    monkeypatch.setattr(session_module, "_local_folder", None)
    assert shared_folder(_Session("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    assert fresh_path(_Session("hdfs://x/y", "yarn"), "a").startswith("hdfs://x/y/lamina/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session(None, "yarn"))
    assert shared_folder(_Session(None, "local[2]")) == shared_folder(_Session(None, "local[2]"))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,CHANNEL,QUANTITY,INVOICENO\nX,web,2,7\n")
    found = read_csv_folder(spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("COUNTRY", "string"), ("CHANNEL", "string"), ("QUANTITY", "int"), ("INVOICENO", "string"),
    ]
    assert rows(found) == [("X", "web", 2, "7")]
    assert rows(found.select("INVOICENO")) == [("7",)]
    (tmp_path / "b.csv").write_text("Country,QUANTITY,CHANNEL,INVOICENO\nX,2,web,7\n")
    with pytest.raises(Exception, match="header"):
        read_csv_folder(spark, str(tmp_path)).collect()


def test_lines_without_an_invoice_number_are_rejected_each_time(spark, warehouse):
    lines = spark.createDataFrame([("1", "a"), (None, "b")], "INVOICENO string, STOCKCODE string")
    first, second = load_bronze(warehouse, lines), load_bronze(warehouse, lines)
    assert (first.stored, first.rejected, second.stored, second.rejected) == (1, 1, 0, 1)
    assert warehouse.scan(INVOICE).count() == 1

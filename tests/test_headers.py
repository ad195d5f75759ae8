"""CSV folders whose files have different headers."""

import gzip
import os
from datetime import datetime

import pytest

from lamina.schemas import INVOICE
from lamina.session import fresh_path
from lamina.sources.csv_files import header_groups, read_csv_by_header, write_csv_folder
from lamina.streaming.arrivals import start_folder_load

STAMP = datetime(2024, 1, 31, 12, 34)
NAMES = INVOICE.schema.names


@pytest.fixture
def inbox(spark):
    path = fresh_path(spark, "inbox")
    os.makedirs(path)
    return path


def put(inbox, name, header, *lines):
    with open(f"{inbox}/{name}", "w", encoding="utf-8") as file:
        file.write("\n".join([header, *lines]) + "\n" if header or lines else "")


def test_each_file_is_read_by_its_own_header(spark, inbox):
    put(inbox, "a.csv", "INVOICENO,QUANTITY,UNITPRICE", "1,2,0.5", "2,x,1")
    put(inbox, "b.csv", "UnitPrice,invoiceno", "2.5,3")
    put(inbox, "c.csv", '\ufeff"INVOICENO","SHIP, TO",quantity', '4,"Oslo, N",7')
    put(inbox, "d.csv", "INVOICENO,QUANTITY,UNITPRICE", "5,1,1")
    put(inbox, "only-header.csv", "INVOICENO,CHANNEL")
    put(inbox, "empty.csv", "")
    groups = header_groups(spark, inbox)
    assert sorted(len(files) for files in groups.values()) == [1, 1, 1, 2]
    df = read_csv_by_header(spark, inbox)
    assert df.columns == [*NAMES, "CHANNEL", "SHIP, TO"]
    assert [f.dataType for f in df.schema][: len(NAMES)] == [f.dataType for f in INVOICE.schema]
    found = {r.INVOICENO: (r.QUANTITY, r.UNITPRICE, r["SHIP, TO"], r.CHANNEL) for r in df.collect()}
    assert found == {
        "1": (2, 0.5, None, None), "2": (None, 1.0, None, None), "3": (None, 2.5, None, None),
        "4": (7, None, "Oslo, N", None), "5": (1, 1.0, None, None),
    }


def test_no_files(spark, inbox):
    df = read_csv_by_header(spark, inbox)
    assert df.columns == NAMES and df.count() == 0


def test_stream_takes_a_new_header_without_a_new_query(spark, inbox, warehouse):
    """The second delivery has another header and a column more; the same query takes it."""
    header = "INVOICENO,STOCKCODE,DESCRIPTION,QUANTITY,INVOICEDATE,UNITPRICE,CUSTOMERID,COUNTRY"
    put(inbox, "a.csv", header, "1,s,d,2,12/1/2010 08:26,0.5,7,Norway")
    load = start_folder_load(warehouse, inbox, fresh_path(spark, "stream"), STAMP)
    load.processAllAvailable()
    put(inbox, "b.csv", "CHANNEL," + header, "web,2,s,d,1,12/1/2010 08:27,1.5,7,Norway", "web,1,z,d,1,x,1,7,Norway")
    load.processAllAvailable()
    load.stop()
    found = {(r.INVOICENO, r.STOCKCODE, r.CHANNEL) for r in warehouse.scan(INVOICE).collect()}
    assert found == {("1", "s", None), ("2", "s", "web")}


def test_headers_are_first_lines_however_tasks_sort(spark, inbox, settings):
    """Several long files would share a task, whose rows do not fit its memory."""
    settings(spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1")
    conf, limit = spark._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    conf.set(limit, "50")
    try:
        for name in "edcba":
            put(inbox, f"{name}.csv", f"INVOICENO,{name}", *[f"{i},{name}" for i in range(300)])
        assert sorted(header_groups(spark, inbox)) == [("INVOICENO", name) for name in "abcde"]
        assert read_csv_by_header(spark, inbox).count() == 1500
    finally:
        conf.remove(limit)


def test_headers_of_compressed_and_split_files(spark, inbox, settings):
    settings(spark__sql__files__maxPartitionBytes="1000")
    put(inbox, "a.csv", "INVOICENO,QUANTITY", *[f"{i},1" for i in range(1000)])
    put(inbox, "empty.csv", "")
    put(inbox, "no-header.csv", "", "1,2")
    with gzip.open(f"{inbox}/b.csv.gz", "wt") as file:
        file.write("\ufeffINVOICENO,Größe\r\n1,2\r\n")
    with gzip.open(f"{inbox}/empty.csv.gz", "wt"):
        pass
    groups = header_groups(spark, inbox)
    assert {names: [f.rsplit("/", 1)[1] for f in files] for names, files in groups.items()} == {
        ("INVOICENO", "QUANTITY"): ["a.csv"], ("INVOICENO", "Größe"): ["b.csv.gz"], (): ["no-header.csv"],
    }


def test_arrived_files_are_listed_without_their_lines(spark, inbox, warehouse):
    header = "INVOICENO,STOCKCODE,DESCRIPTION,QUANTITY,INVOICEDATE,UNITPRICE,CUSTOMERID,COUNTRY"
    for name in "ab":
        put(inbox, f"{name}.csv", header, *[f"{name}{i},s,d,2,12/1/2010 08:26,0.5,7,Norway" for i in range(20)])
    load = start_folder_load(warehouse, inbox, fresh_path(spark, "stream"), STAMP, once=True)
    load.awaitTermination()
    assert sum(p["numInputRows"] for p in load.recentProgress) == 2
    assert warehouse.scan(INVOICE).count() == 40


def test_csv_folders_are_compressed_fast(spark, inbox):
    """Both folders hold the same rows; the level shows in the size."""
    made = spark.range(0, 20_000, 1, 1).selectExpr("id as INVOICENO", "id % 97 as QUANTITY", "'Norway' as COUNTRY")
    write_csv_folder(made, f"{inbox}/fast")
    made.write.option("header", True).csv(f"{inbox}/slow", compression="gzip")
    sizes, texts = {}, {}
    for kind in ("fast", "slow"):
        (name,) = [f for f in os.listdir(f"{inbox}/{kind}") if f.endswith(".csv.gz")]
        sizes[kind] = os.path.getsize(f"{inbox}/{kind}/{name}")
        texts[kind] = gzip.open(f"{inbox}/{kind}/{name}").read()
    assert texts["fast"] == texts["slow"] and sizes["slow"] < sizes["fast"] < len(texts["fast"]) / 2

"""Edge rows of the cleaning steps, as literal frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import invoice_time, load_stamp, natural_key, now, time_of_day, to_working_decimal
from lamina.operators import cleaning

STAMP = datetime(2024, 1, 31, 12, 34)
BRONZE = (
    "INVOICENO string, STOCKCODE string, DESCRIPTION string, QUANTITY string, INVOICEDATE string,"
    " UNITPRICE string, CUSTOMERID bigint, COUNTRY string"
)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12/1/2010 8:26", (date(2010, 12, 1), "08:26")),
        ("01/12/2011 08:05", (date(2011, 1, 12), "08:05")),
        ("13/45/2010 25:61", (None, None)),
        ("2010-12-01", (None, None)),
        ("12/1/2010 8:26:59", (None, None)),
        ("not a date", (None, None)),
        (None, (None, None)),
    ],
)
def test_invoice_dates(spark, text, expected):
    at = invoice_time(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(F.to_date(at), time_of_day(at)).first()
    assert tuple(row) == expected


def test_cancellation_is_three_valued(spark):
    lines = spark.createDataFrame(
        [("C1", None), ("1", None), ("C2", -1), ("C3", 1), ("4", -1), ("5", 1), ("c6", -1)],
        "INVOICENO string, QUANTITY int",
    )
    routed = cleaning.with_route(lines).collect()
    kept = {r.INVOICENO for r in cleaning.invoices(lines).collect()}
    dropped = {r.INVOICENO for r in cleaning.cancelled(lines).collect()}
    assert kept == {"1", "C3", "4", "5", "c6"}
    assert dropped == {"C2"}
    assert {r.INVOICENO: r.ROUTE for r in routed} == {
        **{k: "INVOICE_SILVER" for k in kept},
        "C2": "INVOICE_CANCELLED_SILVER",
        "C1": None,
    }


def test_working_decimal(spark):
    lines = spark.createDataFrame([("abc",), ("1e12",), ("2.345",), ("-2.345",), (None,)], "t string")
    found = [r[0] for r in lines.select(to_working_decimal(F.col("t"))).collect()]
    assert found == [None, None, Decimal("2.35"), Decimal("-2.35"), None]


def test_required_values_are_tested_before_the_casts(spark):
    bronze = spark.createDataFrame(
        [
            ("1", "a", None, "abc", "12/1/2010 8:26", "1.5", 7, "X"),
            ("2", "a", "d", None, "12/1/2010 8:26", "1.5", 7, "X"),
            ("3", "a", "d", "2", "bad", "1.5", None, "X"),
            ("C4", "a", "d", "abc", "bad", "1.5", None, "X"),
        ],
        BRONZE,
    )
    typed = {r.INVOICENO: r for r in cleaning.silver_typed(bronze, STAMP).collect()}
    assert set(typed) == {"1", "3", "C4"}
    assert typed["1"].QUANTITY is None
    assert typed["1"].DESCRIPTION == "SIN_DESCRIPCION"
    assert typed["3"].FECHA_INVOICE is None
    assert {r.INVOICENO for r in cleaning.invoices(cleaning.silver_typed(bronze, STAMP)).collect()} == {"1", "3"}


def test_missing_column_is_an_error(spark, folder):
    from pyspark.errors import AnalysisException

    from lamina.sources.invoices import invoice_lines

    with pytest.raises(AnalysisException):
        cleaning.project_required(invoice_lines(spark, folder).drop("COUNTRY"))


def test_natural_key_is_null_with_a_null_part(spark):
    keys = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "INVOICENO string, STOCKCODE string")
    assert [r[0] for r in keys.select(natural_key()).collect()] == ["a_b", None, None]


def test_load_stamp_is_one_value_per_run(spark):
    stamped = spark.range(1000).withColumns(load_stamp()).drop("id").distinct()
    assert stamped.count() == 1
    fixed = spark.range(1).withColumns(load_stamp(STAMP)).first()
    assert (fixed.FECHA_DE_CARGA, fixed.HORA_DE_CARGA) == (date(2024, 1, 31), "12:34")


def test_typed_lines_split_without_loss(spark, folder):
    from lamina.sources.invoices import invoice_lines

    typed = cleaning.silver_typed(invoice_lines(spark, folder), STAMP)
    routes = {r.ROUTE: r["count"] for r in cleaning.with_route(typed).groupBy("ROUTE").count().collect()}
    assert sum(routes.values()) == typed.count()
    assert {name: df.count() for name, df in cleaning.route(typed).items()} == routes


def test_cancelled_prefix_reaches_the_scan(spark, folder, tmp_path):
    from lamina.sources.invoices import invoice_lines

    stored = str(tmp_path / "bronze")
    invoice_lines(spark, folder).write.parquet(stored)
    plan = cleaning.cancelled(cleaning.silver_typed(spark.read.parquet(stored), STAMP))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(INVOICENO,C)" in text
    assert "CUSTOMERID" not in text
    assert "Exchange" not in text


def test_now_follows_the_session_time_zone(spark, settings):
    settings(spark__sql__session__timeZone="UTC")
    utc = now(spark)
    settings(spark__sql__session__timeZone="Asia/Tokyo")
    assert round((now(spark) - utc).total_seconds() / 3600) == 9

from decimal import Decimal

from pyspark.sql import types as T

from lamina.operators.evolution import conform, new_columns, schema_diff, warehouse_type


def test_warehouse_types():
    expected = {
        T.StringType(): "STRING",
        T.IntegerType(): "NUMBER",
        T.FloatType(): "FLOAT",
        T.BooleanType(): "BOOLEAN",
        T.TimestampType(): "TIMESTAMP",
        T.DecimalType(10, 2): "NUMBER",
        T.DoubleType(): "STRING",
        T.LongType(): "STRING",
        T.DateType(): "STRING",
    }
    assert {t: warehouse_type(t) for t in expected} == expected


def test_names_compare_without_case(spark):
    incoming = spark.createDataFrame([(1, 2, 3)], "invoiceno int, Extra int, other int")
    target = T.StructType([T.StructField("INVOICENO", T.StringType()), T.StructField("OTHER", T.IntegerType())])
    assert [f.name for f in new_columns(incoming.schema, target)] == ["Extra"]
    assert [tuple(r) for r in schema_diff(incoming, target).collect()] == [("Extra", "int", "NUMBER", 1)]


def test_no_difference(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert schema_diff(df, df.schema).collect() == []


def test_conform(spark):
    df = spark.createDataFrame([("2.50", "x"), ("-2.50", "y"), ("z", "z")], "quantity string, extra string")
    schema = T.StructType(
        [T.StructField("MISSING", T.DateType()), T.StructField("QUANTITY", T.DecimalType(38, 0))]
    )
    result = conform(df, schema)
    assert result.columns == ["MISSING", "QUANTITY"]
    assert [r.QUANTITY for r in result.collect()] == [Decimal("3"), Decimal("-3"), None]


def test_values_that_do_not_fit_are_kept_as_text(spark, warehouse):
    """Halves, text and too large numbers among whole ones; then a delivery of the declared types again."""
    from lamina.operators import cleaning
    from lamina.plans.layers import load_bronze
    from lamina.schemas import INVOICE

    schema = "INVOICENO string, STOCKCODE string, DESCRIPTION string, QUANTITY {}, INVOICEDATE string, UNITPRICE {}, CUSTOMERID long, COUNTRY string"
    plain = [("1", "a", "x", 2, "12/1/2010 8:26", 1.5, 7, "X")]
    odd = [("2", "a", "x", "2.5", "12/1/2010 8:26", "n/a", 7, "X"), ("3", "a", "x", "9999999999", "", " 1.25", 7, "X"),
           ("4", "a", "x", "3", "", "2", None, "X"), ("5", "a", "x", None, "", "2", None, "X")]
    first = load_bronze(warehouse, spark.createDataFrame(plain, schema.format("int", "double")))
    assert first.rescued == 0 and "RESCUED_VALUES" not in warehouse.scan(INVOICE).columns
    second = load_bronze(warehouse, spark.createDataFrame(odd, schema.format("string", "string")))
    assert second.rescued == 2 and second.offered == 4
    last = load_bronze(warehouse, spark.createDataFrame([("6", *plain[0][1:])], schema.format("int", "double")))
    assert last.rescued == 0
    stored = {r.INVOICENO: r for r in warehouse.scan(INVOICE).collect()}
    assert stored["2"].RESCUED_VALUES == {"QUANTITY": "2.5", "UNITPRICE": "n/a"}
    assert stored["3"].RESCUED_VALUES == {"QUANTITY": "9999999999"} and stored["3"].UNITPRICE == 1.25
    assert stored["4"].RESCUED_VALUES is None and stored["4"].QUANTITY == 3
    silver = {r.INVOICENO: (r.QUANTITY, r.UNITPRICE) for r in cleaning.silver_typed(warehouse.scan(INVOICE)).collect()}
    assert {k: [str(x) for x in v] for k, v in silver.items()} == {
        "1": ["2.00", "1.50"], "2": ["2.50", "None"], "3": ["None", "1.25"], "4": ["3.00", "2.00"], "6": ["2.00", "1.50"],
    }

"""Invoice lines in the bronze shape, derived from the order tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.temporal import INVOICE_TIME_FORMAT

# Fixed values of the mapping: which rows carry a missing or unusable value.
NO_PRODUCT, NO_DESCRIPTION, NO_COUNTRY, NO_DATE = 211, 50, 97, 101
BAD_DATE = "not a date"

# Columns of a later, wider delivery.
EXTRA_COLUMNS = {
    "LINESTATUS": "l_linestatus",
    "SHIPDATE": "cast(l_shipdate as date)",
    "DISCOUNT": "cast(l_discount as float)",
    "TAX": "l_tax",
    "LINENUMBER": "l_linenumber",
}


def use_all_cores(df: DataFrame, *by: str) -> DataFrame:
    """Spread a scan with fewer splits than cores over the cores.

    Only a small input has so few splits. With many files nothing happens, so
    no shuffle is added where it would cost.
    """
    spark = df.sparkSession
    tasks = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *by) if df.rdd.getNumPartitions() < tasks else df


def invoice_lines(spark: SparkSession, folder: str, extra: Iterable[str] = ()) -> DataFrame:
    """One line per order line, with the named ``EXTRA_COLUMNS``.

    Plain equi-joins: the optimizer prunes the columns and broadcasts the sides
    it knows to be small. Countries go to the orders before the lines do, so lines are
    shuffled for their product and their order only, and those of an order end up together.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    buyers = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    placed = table("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        use_all_cores(table("lineitem"), "l_orderkey", "l_linenumber")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    returned = F.col("l_returnflag") == "R"
    negative = (returned & (F.col("l_linenumber") != 1)) | (
        (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
    )
    at = F.col("o_orderdate") + F.expr(
        "make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int), cast(o_orderkey % 60 as int), 0)"
    )
    columns = {
        "INVOICENO": F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")),
        "STOCKCODE": F.when(F.col("l_partkey") % NO_PRODUCT != 0, F.col("l_partkey").cast("string")),
        "DESCRIPTION": F.when(F.col("p_partkey") % NO_DESCRIPTION != 0, F.col("p_name")),
        "QUANTITY": F.when(negative, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int"),
        "INVOICEDATE": F.when(F.col("o_orderkey") % NO_DATE == 0, BAD_DATE).otherwise(
            F.date_format(at, INVOICE_TIME_FORMAT)
        ),
        "UNITPRICE": F.col("l_extendedprice") / F.col("l_quantity"),
        "CUSTOMERID": F.col("o_custkey"),
        "COUNTRY": F.when(F.col("c_custkey") % NO_COUNTRY != 0, F.col("n_name")),
    }
    columns |= {name: F.expr(EXTRA_COLUMNS[name]) for name in extra}
    return joined.select(*[c.alias(name) for name, c in columns.items()])

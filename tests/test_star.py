from datetime import date, datetime
from decimal import Decimal

import pytest

from lamina.operators.star import COUNTRY, DATE, DIMENSIONS, KEY, LINE, PRODUCT, dimension_rows, fact_rows, star
from lamina.operators.surrogate import dense_ids
from lamina.schemas import INVOICE_SILVER
from tests.conftest import final_plan

STAMP = datetime(2024, 1, 31, 12, 34)


def silver(spark, lines):
    return spark.createDataFrame(
        [
            (no, code, "d", Decimal(quantity), Decimal("1.50"), country, day, time, STAMP.date(), "12:34")
            for no, code, quantity, country, day, time in lines
        ],
        INVOICE_SILVER.schema,
    )


def build(lines, grain):
    dims = {d.table.name: dense_ids(dimension_rows(lines, d, STAMP, grain), d.id_col) for d in DIMENSIONS}
    facts = dense_ids(fact_rows(lines, STAMP), "INVOICE_FACT_ID")
    return star(facts, dims, grain), dims


DAY = date(2010, 12, 1)


def test_repeated_key_fans_out_at_line_grain(spark):
    lines = silver(spark, [("1", "a", 1, "X", DAY, "08:26")] * 2 + [("2", "b", 1, "X", DAY, "08:26")])
    facts, _ = build(lines, LINE)
    assert facts.count() == 16 + 1
    assert facts.distinct().count() == 16 + 1


def test_repeated_key_gives_one_row_per_line_at_key_grain(spark):
    lines = silver(spark, [("1", "a", 1, "X", DAY, "08:26")] * 2 + [("2", "b", 1, "X", DAY, "08:26")])
    facts, dims = build(lines, KEY)
    assert facts.count() == 3
    assert {name: df.count() for name, df in dims.items()} == {d.table.name: 2 for d in DIMENSIONS}


def test_lines_of_one_key_find_their_own_attributes(spark):
    lines = silver(
        spark,
        [
            ("1", "a", 1, "X", DAY, "08:26"),
            ("1", "a", 2, "X", DAY, "08:27"),
            ("1", "a", 3, "Y", DAY, "08:27"),
        ],
    )
    facts, dims = build(lines, KEY)
    found = facts.join(dims[DATE.table.name], DATE.id_col).join(dims[COUNTRY.table.name], COUNTRY.id_col)
    assert sorted((int(r.QUANTITY), r.HORA_MINUTO, r.COUNTRY) for r in found.collect()) == [
        (1, "08:26", "X"),
        (2, "08:27", "X"),
        (3, "08:27", "Y"),
    ]


def test_line_without_a_dimension_row_is_left_out(spark):
    lines = silver(spark, [("1", "a", 1, "X", None, None), ("2", "b", 1, "X", DAY, "08:26")])
    for grain in (LINE, KEY):
        dims = {d.table.name: dense_ids(dimension_rows(lines, d, STAMP, grain), d.id_col) for d in DIMENSIONS}
        dims[DATE.table.name] = dims[DATE.table.name].dropna(subset=["FECHA_INVOICE"])
        facts = star(dense_ids(fact_rows(lines, STAMP), "INVOICE_FACT_ID"), dims, grain)
        assert [r.PK_INVOICENO_STOCKCODE for r in facts.collect()] == ["2_b"]


def test_hot_key_is_split_in_every_join_of_the_key_grain(spark, folder, tmp_path, settings):
    """A third of all lines carry one invoice and one product."""
    from pyspark.sql import functions as F

    from lamina.plans.queries import _silver

    hot = F.col("QUANTITY") % 3 == 0
    path = str(tmp_path / "silver")
    _silver(spark, folder).withColumns(
        {
            "INVOICENO": F.when(hot, "7").otherwise(F.col("INVOICENO")),
            "STOCKCODE": F.when(hot, "7").otherwise(F.col("STOCKCODE")),
            "COUNTRY": F.when(hot, "X").otherwise(F.col("COUNTRY")),
            "FECHA_INVOICE": F.when(hot, F.lit(DAY)).otherwise(F.coalesce("FECHA_INVOICE", F.lit(DAY))),
            "HORA_MINUTO_VARCHAR": F.when(hot, "08:26").otherwise(F.coalesce("HORA_MINUTO_VARCHAR", F.lit("08:26"))),
        }
    ).repartition(16).write.parquet(path)
    lines = spark.read.parquet(path)
    dims = {d.table.name: dense_ids(dimension_rows(lines, d, STAMP, KEY), d.id_col) for d in DIMENSIONS}
    settings(
        spark__sql__shuffle__partitions="64",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    facts = star(fact_rows(lines, STAMP), dims, KEY)
    plan = final_plan(facts)
    final = plan[: plan.index("Initial Plan")]
    assert final.count("skew=true") == len(DIMENSIONS)
    assert facts.count() == lines.count()


def test_product_dimension_has_no_description():
    assert "DESCRIPTION" not in PRODUCT.table.schema.names


def test_unknown_grain(spark):
    with pytest.raises(ValueError, match="grain"):
        dimension_rows(silver(spark, []), DATE, STAMP, "invoice")

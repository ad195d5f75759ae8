from datetime import datetime

from pyspark.sql import functions as F

from lamina.operators import cleaning
from lamina.plans import checks
from lamina.plans.layers import resolved_facts, run_increment
from lamina.plans.queries import _stored_bronze
from lamina.operators.quality import not_leased
from lamina.schemas import COUNTRY_DIM, INVOICE_FACT_TABLE, INVOICE_SILVER, TABLES, VIOLATIONS
from lamina.session import materialize
from lamina.sources.invoices import invoice_lines
from lamina.sources.tables import Warehouse
from tests.conftest import rows

EARLY, LATE = datetime(2024, 1, 30, 9, 0), datetime(2024, 1, 31, 12, 34)


def test_ids_outside_a_lease(spark):
    df = spark.createDataFrame([(4,), (5,), (6,), (7,), (None,)], "id long")
    assert sorted((r.id is None, r.id) for r in not_leased(df, "id", 5, 7).collect()) == [(False, 4), (False, 7), (True, None)]
    assert not_leased(df.limit(0), "id", 5, 7).count() == 0


def test_checks_read_one_load(spark, folder, warehouse):
    """A clean run has no violation; later ones are found in their load, once however often it is checked."""
    lines = materialize(invoice_lines(spark, folder), "lines")
    run_increment(warehouse, materialize(_stored_bronze(lines), "early"), EARLY, load="early")
    assert checks.check_run(warehouse, "early", EARLY).count() == 0

    class Spoilt(Warehouse):
        def append(self, table, df, *given, **named):
            if table.name == "INVOICE_FACT_TABLE":
                stored_id = self.scan(INVOICE_FACT_TABLE).agg(F.min("INVOICE_FACT_ID")).first()[0]
                df = df.withColumn("INVOICE_FACT_ID", F.when(F.col("QUANTITY") == 7, stored_id).otherwise(F.col("INVOICE_FACT_ID")))
                df = df.withColumn("COUNTRY_ID", F.when(F.col("QUANTITY") == 8, None).otherwise(F.col("COUNTRY_ID")))
                df = df.withColumn("INVOICE_DATE_ID", F.when(F.col("QUANTITY") == 9, -1).otherwise(F.col("INVOICE_DATE_ID")))
            return super().append(table, df, *given, **named)

    run_increment(Spoilt(spark, warehouse.root, warehouse.prefix), lines, LATE, load="late")
    late = warehouse.scan(INVOICE_FACT_TABLE).filter(F.col("FECHA_DE_CARGA") == F.lit(LATE.date()))
    sevens, nines = (late.filter(F.col("QUANTITY") == q).count() for q in (7, 9))
    assert sevens > 1 and nines > 0
    for _ in range(2):
        found = checks.check_run(warehouse, "late", LATE).select("TABLE_NAME", "CONSTRAINT_TYPE", "KEY_VALUE", "REASON", "ROW_COUNT")
        planted = late.filter("QUANTITY = 7").first().INVOICE_FACT_ID
        assert rows(found) == [
            ("INVOICE_FACT_TABLE", "FOREIGN KEY", "-1", "NO PARENT", nines),
            ("INVOICE_FACT_TABLE", "PRIMARY KEY", str(planted), "NOT LEASED", sevens),
            ("INVOICE_FACT_TABLE", "PRIMARY KEY", str(planted), "REPEATED", sevens),
        ]
    assert checks.check_run(warehouse, "early", EARLY).count() == 0
    found = checks.check_declared(warehouse, INVOICE_FACT_TABLE, "late").select("ROW_COUNT")
    assert rows(found) == sorted([(sevens,), (sevens,), (nines,)])
    assert checks.check_declared(warehouse, COUNTRY_DIM, "unknown").count() == 0
    assert warehouse.scan(VIOLATIONS).count() == 3

    ledger = warehouse.ledger(INVOICE_FACT_TABLE)
    taken = next(r for r in ledger.loads() if r.LOAD == "late")
    read = checks._rows_of(warehouse, INVOICE_FACT_TABLE, ledger, taken, LATE).inputFiles()
    assert read and not [f for f in read if str(EARLY.date()) in f]


def test_a_load_killed_at_every_step(spark, folder, warehouse):
    """Every append fails once before and once after its rows are stored; the same load is run until it ends."""
    lines = materialize(invoice_lines(spark, folder), "lines")
    lost = set()

    class Killed(Warehouse):
        def _lose(self, table, when):
            if (table.name, when) not in lost:
                lost.add((table.name, when))
                raise InterruptedError(f"{when} {table.name}")

        def append(self, table, *given, **named):
            self._lose(table, "before")
            done = super().append(table, *given, **named)
            self._lose(table, "after")
            return done

    target = Killed(spark, warehouse.root, warehouse.prefix)
    for _ in range(30):
        try:
            run_increment(target, lines, LATE, load="only")
            break
        except InterruptedError:
            continue
    else:
        raise AssertionError("the load never ended")
    assert lost == {(name, when) for name in TABLES for when in ("before", "after")}
    assert warehouse.scan(INVOICE_SILVER).count() == cleaning.invoices(cleaning.silver_typed(lines, LATE)).count()
    assert warehouse.scan(TABLES["INVOICE"]).count() == lines.count()
    facts = warehouse.scan(INVOICE_FACT_TABLE)
    assert facts.count() == facts.select("INVOICE_FACT_ID").distinct().count() == resolved_facts(warehouse).count() == 4190
    assert checks.check_run(warehouse, "only", LATE).count() == 0

"""Every query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from lamina.plans import oracle
from lamina.plans import queries as plans

QUERIES, SQL = plans.queries(), oracle.oracle_sql()

# Rows at the smallest scale, counted independently when the mapping was designed.
EXPECTED_ROWS = {
    "bronze": 6000,
    "silver_typed": 5876,
    "silver_invoices": 4226,
    "silver_cancelled": 1650,
    "incr_silver": 2245,
    "dim_date": 4190,
    "reject_not_null": 36,
    "gold_fact": 4568,
    "gold_fact_per_line": 4190,
}


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None:
            return "<null>"
        return repr(round(value, 6)) if isinstance(value, float) else str(value)

    return [columns[i] for i in order], sorted(tuple(text(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(name, spark, folder, duck):
    ours = QUERIES[name](spark, folder)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    found = ours.collect()
    assert canonical(ours.columns, found) == canonical(columns, result.fetchall())
    assert found
    if name in EXPECTED_ROWS:
        assert len(found) == EXPECTED_ROWS[name]


def test_entry(spark):
    assert entry_module.entry(spark).count() == EXPECTED_ROWS["gold_fact_per_line"]

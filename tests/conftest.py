import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lamina.plans.queries import _warehouse  # noqa: E402
from lamina.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{FOLDER}/{file}'")
    return con


@pytest.fixture
def warehouse(spark):
    return _warehouse(spark)


@pytest.fixture
def settings(spark):
    """Sets session options and puts the old ones back afterwards."""
    old = {}

    def put(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    """The plan after adaptive execution, as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())

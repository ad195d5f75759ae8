import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.operators import surrogate
from lamina.operators.surrogate import dense_ids, next_id, sparse_ids


def test_dense_equals_row_number(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_returnflag", "l_partkey", "l_quantity")
    ours = dense_ids(lines, "id", start=100)
    one_task = lines.withColumn("id", F.row_number().over(Window.orderBy(*lines.columns)).cast("long") + 99)
    assert ours.exceptAll(one_task).count() == 0
    assert one_task.exceptAll(ours).count() == 0


def test_copies_of_one_row_spread_over_tasks(spark, settings):
    """Two thirds of the rows are the same row."""
    copies = spark.range(30000).select(F.when(F.col("id") % 3 != 0, -1).otherwise(F.col("id")).alias("v"))
    settings(spark__sql__adaptive__enabled="false")
    numbered = dense_ids(copies, "n", ["v"])
    assert numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (0, 29999, 30000)
    in_order = copies.repartitionByRange(8, "v")
    assert _largest_part(in_order) > 15000
    ranged = copies.withColumn("p", F.monotonically_increasing_id()).repartitionByRange(8, "v", "p")
    assert _largest_part(ranged) < 10000


def _largest_part(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@hypothesis_settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=40), start=st.integers(0, 9))
def test_dense_ids_are_consecutive(spark, values, start):
    numbered = dense_ids(spark.createDataFrame([(v,) for v in values], "v int"), "n", start=start).collect()
    assert sorted(r.n for r in numbered) == list(range(start, start + len(values)))
    by_id = [r.v for r in sorted(numbered, key=lambda r: r.n)]
    assert by_id == sorted(values, key=lambda v: (v is not None, v or 0))


def test_sparse_ids_stay_unique_over_loads(spark):
    first = sparse_ids(spark.range(0, 1000, 1, 7), "n", start=0)
    again = sparse_ids(spark.range(0, 1000, 1, 3), "n", start=next_id(first, "n"))
    both = first.union(again)
    assert both.select("n").distinct().count() == 2000
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_sparse_ids_refuse_partitions_beyond_the_stride(spark, monkeypatch):
    monkeypatch.setattr(surrogate, "PARTITION_STRIDE", 2)
    assert sparse_ids(spark.range(0, 10, 1, 2), "n").select("n").distinct().count() == 10
    with pytest.raises(Exception, match="fewer than 2 partitions"):
        sparse_ids(spark.range(0, 10, 1, 3), "n").collect()


def test_next_id(spark):
    assert next_id(spark.createDataFrame([], "n bigint"), "n") == 0
    assert next_id(spark.createDataFrame([(4,), (9,), (None,)], "n bigint"), "n") == 10

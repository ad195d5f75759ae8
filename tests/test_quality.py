from lamina.operators.profiling import observed, profile_frame
from lamina.operators.quality import orphans, repeated_keys, split_required
from tests.conftest import final_plan, rows


def test_split_required(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, None, None)], "id int, x string, y string")
    accepted, rejected = split_required(df, ["x", "y"])
    assert rows(accepted) == [(1, "a", "b")]
    assert sorted((r.id, r.REJECT_REASON) for r in rejected.collect()) == [(2, "x"), (3, "x,y")]
    everything, nothing = split_required(df, [])
    assert (everything.count(), nothing.count()) == (3, 0)


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(repeated_keys(df, "k")) == [("a", 2)]


def test_repeated_keys_collapse_before_the_shuffle(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    plan = final_plan(repeated_keys(lines, ["l_orderkey", "l_partkey"]))
    final = plan[: plan.index("Initial Plan")]
    assert final.rindex("HashAggregate") > final.rindex("Exchange")


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, ref bigint")
    parent = spark.createDataFrame([(10,), (10,), (None,)], "key bigint")
    assert rows(orphans(child, "ref", parent, "key")) == [(2, 11)]


def test_profile_comes_from_the_action_itself(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    counted, observation = observed(df, "profile")
    counted.write.format("noop").mode("overwrite").save()
    assert rows(profile_frame(df, observation)) == [("x", 2, 1), ("y", 2, 2)]

"""Helper semantics: exact explode, spread, shared folder."""

from pyspark.sql import functions as F

from lodestone.functions.generators import explode_exact
from lodestone.session import shared_path, shared_root, spread


def test_explode_exact_equals_explode(spark):
    df = spark.createDataFrame([(1, [1, None, 3]), (2, []), (3, None)], "k int, a array<int>")
    plain = sorted(map(tuple, df.select("k", F.explode("a").alias("x")).collect()), key=repr)
    exact = sorted(map(tuple, explode_exact(df, ["k"], F.col("a"), ["x"]).collect()), key=repr)
    assert exact == plain == sorted([(1, 1), (1, None), (1, 3)], key=repr)
    with_pos = explode_exact(df, ["k"], F.col("a"), ["x"], position="p").orderBy("p").collect()
    assert [(r["p"], r["x"]) for r in with_pos] == [(0, 1), (1, None), (2, 3)]


def test_explode_exact_plans_no_inferred_filter(spark):
    df = spark.createDataFrame([("a b c",)], "t string")
    q = explode_exact(df, [], F.split("t", " "), ["w"])
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_spread_only_below_parallelism(spark):
    one = spark.range(0, 1000, numPartitions=1)
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many).rdd.getNumPartitions() == 64


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert root and shared_path(spark, "x").startswith(root)
    assert shared_path(spark, "x") != shared_path(spark, "x")

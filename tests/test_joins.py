"""Joins with hot keys, and properties of the plans."""

import random

import pytest
from pyspark.sql import functions as F

from loanlake.operators.joins import keyed_join, without_match
from loanlake.plans.catalog import QUERIES, run_query

SMALLEST = "/root/testdata/sf0.001"
SPREAD = {"small_bytes": 0, "rows_per_task": 500}


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows share one key and a tenth have none."""
    rng = random.Random(3)

    def key():
        draw = rng.random()
        return "hot" if draw < 0.33 else None if draw < 0.43 else f"k{rng.randint(0, 400)}"

    left = spark.createDataFrame([(key(), i % 50) for i in range(9000)], "k string, x int")
    right = spark.createDataFrame(
        [(f"k{i}", i) for i in range(300)] + [("hot", -1), ("hot", -2), (None, -3), ("k1", -4)],
        "k string, y int",
    )
    return left.repartition(16).cache(), right.cache()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_keyed_join_equals_plain_join(sides, how, null_safe):
    left, right = sides
    a, b = left.alias("a"), right.alias("b")
    same = F.col("a.k").eqNullSafe(F.col("b.k")) if null_safe else F.col("a.k") == F.col("b.k")
    expected = bag(a.join(b, same, how).select("a.k", "x", "y"))
    assert bag(keyed_join(left, right, "k", how, null_safe=null_safe)) == expected


@pytest.fixture()
def small_partitions(spark):
    """Settings under which Spark treats this test's rows as it does large data."""
    changed = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512b",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def task_rows(df):
    """Rows of each task, with all columns read."""
    counted = df.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.max(F.xxhash64(*df.columns))
    )
    return sorted(r["n"] for r in counted.collect())


def test_a_hot_left_key_is_split(spark, small_partitions):
    left = spark.range(0, 60_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 10 = 1, null, concat('k', id % 4000))) as k",
        "sha2(string(id), 256) as x",
    )
    right = spark.range(4000).selectExpr("if(id = 0, 'hot', concat('k', id)) as k", "id as y")
    for how in ("left", "inner"):
        rows = task_rows(keyed_join(left, right, "k", how))
        assert rows[-1] < 0.1 * sum(rows)


def test_a_key_hot_on_both_sides_is_split(spark, small_partitions):
    sides = spark.range(0, 6_000, 1, 16).selectExpr(
        "if(id % 6 = 0, -1, id) as k", "sha2(string(id), 256) as x"
    )
    left, right = sides, sides.withColumnRenamed("x", "y")
    rows = task_rows(keyed_join(left, right, "k", "inner"))
    assert sum(rows) == 1000 * 1000 + 5000
    assert rows[-1] < 0.2 * sum(rows)


def test_columns_with_odd_names_pass_through(spark):
    left = spark.createDataFrame([("a", 1)], "k string, `x.y (z)` int")
    right = spark.createDataFrame([("a", 2)], "k string, `v.w` int")
    got = keyed_join(left, right, "k")
    assert got.columns == ["k", "x.y (z)", "v.w"]
    assert bag(got) == [("a", 1, 2)]


def test_bad_join_arguments(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([("1", 2)], "k string, y int")
    with pytest.raises(TypeError, match="k"):
        keyed_join(left, right, "k")
    with pytest.raises(ValueError, match="full"):
        keyed_join(left, left, "k", "full")


def test_without_match_counts_rows_per_key(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "k string")
    right = spark.createDataFrame([("b",), (None,)], "id string")
    assert bag(without_match(left, right, "k", "id")) == [("a", 2), ("c", 1)]


def plan(spark, name):
    return run_query(name, spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_leaves_the_engine(spark, name):
    text = plan(spark, name)
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_keep_first_limits_before_the_shuffle(spark):
    text = plan(spark, "dim_employment")
    assert text.count("WindowGroupLimit") == 2


def test_hashed_fact_has_one_shuffle(spark):
    """The full-row distinct."""
    assert plan(spark, "fact_loans").count("ENSURE_REQUIREMENTS") == 1


def test_mart_needs_no_applicant_branch(spark):
    """Orders, customers (source join), line items and bureau rows: one scan each."""
    assert plan(spark, "loan_performance_mart").count("FileScan") == 4


def test_dimension_reads_only_its_columns(spark):
    text = plan(spark, "report_education")
    assert "o_totalprice" not in text
    assert "PushedFilters" in text


def test_checks_of_a_table_share_one_pass(spark):
    assert plan(spark, "dq_between").count("FileScan") == plan(spark, "fact_loans").count("FileScan")

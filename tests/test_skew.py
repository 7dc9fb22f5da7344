"""What adaptive execution makes of frequent keys, read off the plans that were run."""

import pytest
from pyspark.sql import functions as F

from pitchflow.operators import relational
from pitchflow.operators.ordered import fill_up
from pitchflow.operators.relational import left_join_suffixed

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 200_000


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def run(df):
    execution = df._jdf.queryExecution()
    rows = execution.toRdd().count()
    return rows, execution.executedPlan().toString().split("== Initial Plan ==")[0]


def test_third_of_the_left_rows_without_key(small_partitions):
    spark = small_partitions
    left = spark.range(0, ROWS, 1, 8).selectExpr("id", "if(id % 3 = 0, NULL, id % 5000) AS k", "xxhash64(id) AS x")
    right = spark.range(0, 5000, 1, 4).selectExpr("if(id = 7, NULL, id) AS rk", "id * 2 AS y")
    rows, plan = run(left_join_suffixed(left, right, [("k", "rk")]))
    assert rows == ROWS and "skew=true" in plan


def test_third_of_the_right_rows_with_one_key(small_partitions):
    spark = small_partitions
    left = spark.range(0, 3000, 1, 4).selectExpr("id", "id % 1000 AS k")
    right = spark.range(0, ROWS, 1, 8).selectExpr("if(id % 3 = 0, 5L, id % 100000) AS rk", "xxhash64(id) AS y")
    plain = left_join_suffixed(left, right, [("k", "rk")], hot_right_rows=None)
    split = left_join_suffixed(left, right, [("k", "rk")], hot_right_rows=10_000)
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.col("y") % 1000), F.sum("id")).first()
    assert total(plain) == total(split)
    rows, plan = run(split)
    assert "_rpart" in plan and plan.count("Range (") == 3  # the left side once, the right side twice
    # The third of the right rows with one key is dealt into parts.
    parts = right.where("rk = 5").groupBy(F.expr("pmod(xxhash64(rk, y), 16)")).count()
    assert parts.count() == 16 and parts.agg(F.max("count")).first()[0] < ROWS / 3 / 8


@pytest.mark.parametrize("hot", [1, 40, None])
def test_split_keys_keep_every_row(spark, hot):
    left = spark.range(0, 400).selectExpr("id", "if(id % 7 = 0, NULL, id % 11) AS k", "if(id % 5 = 0, NULL, id % 3) AS g")
    right = spark.range(0, 300).selectExpr("if(id % 4 = 0, NULL, id % 9) AS rk", "if(id % 6 = 0, NULL, id % 3) AS g", "id AS y")
    joined = left_join_suffixed(left, right, [("k", "rk")], scope=["g"], hot_right_rows=hot)
    want = left.alias("l").join(right.alias("r"), F.expr("l.k <=> r.rk AND l.g = r.g"), "left").selectExpr("id", "k", "l.g", "y")
    assert sorted(map(str, joined.select("id", "k", "g", "y").collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("cell_rows", [1, 7, 12, 30])
def test_grid_of_a_split_key_keeps_every_row(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(relational, "CELL_ROWS", cell_rows)
    left = spark.range(0, 400).selectExpr("id", "if(id % 7 = 0, NULL, id % 11) AS k", "map('a', id) AS m").unionAll(
        spark.sql("SELECT 1L, 1L, map('a', 1L) FROM range(20)")
    )
    right = spark.range(0, 300).selectExpr("if(id % 4 = 0, NULL, id % 9) AS rk", "id AS y").unionAll(spark.sql("SELECT 1L, 1L FROM range(20)"))
    joined = left_join_suffixed(left, right, [("k", "rk")], hot_right_rows=1)
    want = left.alias("l").join(right.alias("r"), F.expr("l.k <=> r.rk"), "left").selectExpr("id", "k", "m", "y")
    assert sorted(map(str, joined.select("id", "k", "m", "y").collect())) == sorted(map(str, want.collect()))


def exploded(plan):
    """Rows out of each explode of a plan that was run, by its output column."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return exploded(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return exploded(plan.plan())
    found = {}
    if plan.nodeName() == "Generate":
        text = plan.toString().split("\n")[0]
        found["left" if "_lpart" in text else "right"] = plan.metrics().apply("numOutputRows").value()
    for i in range(plan.children().size()):
        found |= exploded(plan.children().apply(i))
    return found


def test_left_rows_are_not_repeated_for_few_right_rows(spark):
    # 40 right rows a key fit one part: the 16 cells share the left rows out instead of repeating them.
    left = spark.range(0, 1000).selectExpr("id", "id % 10 AS k")
    right = spark.range(0, 400).selectExpr("id % 10 AS rk", "id AS y")
    execution = left_join_suffixed(left, right, [("k", "rk")], hot_right_rows=1)._jdf.queryExecution()
    assert execution.toRdd().count() == 40_000
    assert exploded(execution.executedPlan()) == {"left": 1000, "right": 400 * 16}

import random

import pytest
from pyspark.sql import functions as F

from starflow.operators.keys import hash_key, number_by_order
from starflow.operators.lookup import attach


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbers_do_not_depend_on_partitions(spark, workspace, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys = [f"k{i * 7919 % 5000}" for i in range(5000)] + [None]
        df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
        numbered = number_by_order(df, [F.col("k").asc_nulls_first()], "n", workspace)
        got = {r["k"]: r["n"] for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = [None] + sorted(k for k in keys if k is not None)
    assert got == {k: i + 1 for i, k in enumerate(order)}


def test_numbering_an_empty_table(spark, workspace):
    df = spark.createDataFrame([], "k string")
    assert number_by_order(df, [F.col("k").asc()], "n", workspace).count() == 0


def test_hash_key_tells_null_and_swapped_keys_apart(spark):
    rows = [("a", None), (None, "a"), (None, None), ("a", "a"), ("", None)]
    df = hash_key(spark.createDataFrame(rows, "x string, y string"), ["x", "y"], "k")
    assert df.select("k").distinct().count() == len(rows)


def lookup_case():
    rnd = random.Random(11)
    rows = []
    for i in range(2000):
        key = "hot" if i % 3 == 0 else rnd.choice([None, "absent", *[f"k{j}" for j in range(200)]])
        rows.append((i, key))
    counts = {}
    for _, k in rows:
        counts[k] = counts.get(k, 0) + 1
    table = [(k, n, (0 if k is None else len(k)) * 1000 + n) for k, n in counts.items() if k != "absent"]
    return rows, table


MODES = {
    "broadcast": dict(),
    "shuffle": dict(broadcast_bytes=0),
    "shuffle, counted": dict(broadcast_bytes=0, hot_keys=50),
    "shuffle, none hot": dict(broadcast_bytes=0, hot_keys=1),
    "shuffle, weighted": dict(broadcast_bytes=0, weight="w", hot_keys=50),
    "shuffle, all hot": dict(broadcast_bytes=0, weight="w", hot_keys=100_000),
}


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("mode", MODES)
def test_attach_equals_a_dictionary(spark, mode, null_safe):
    rows, table = lookup_case()
    df = spark.createDataFrame(rows, "id int, k string")
    lookup = spark.createDataFrame(table, "k string, w bigint, v bigint")
    got = attach(df, lookup, ["k"], ["v"], null_safe=null_safe, **MODES[mode])
    assert got.columns == ["id", "k", "v"]
    values = {k: v for k, _, v in table if null_safe or k is not None}
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [
        (i, values.get(k)) for i, k in rows
    ]


def test_composite_key_with_odd_names(spark):
    df = spark.createDataFrame([(1, 2020, 4), (2, 2020, None)], "id int, Year int, `Month #` int")
    lookup = spark.createDataFrame([(2020, 4, 9), (2020, None, 8)], "Year int, `Month #` int, d int")
    for mode in (dict(), dict(broadcast_bytes=0)):
        got = attach(df, lookup, ["Year", "Month #"], ["d"], **mode).orderBy("id").collect()
        assert [r["d"] for r in got] == [9, None]


def test_idle_rows_are_spread_in_the_shuffle(spark):
    """The spread must be a join key, or rows without a partner meet in one task."""
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 9 > 7 THEN 'a' END AS k")
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach(df, lookup, ["k"], ["v"], broadcast_bytes=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchange = next(l for l in plan.splitlines() if "Exchange hashpartitioning" in l)
    assert "_spread" in exchange


def test_reserved_names_are_refused(spark):
    df = spark.range(2).withColumn("_spread", F.lit(1))
    with pytest.raises(ValueError, match="itself"):
        attach(df, spark.range(2).withColumn("x", F.lit(1)), ["id"], ["x"])


def test_idle_rows_are_spread_by_a_row_id(spark):
    """Identical rows without a partner do not meet in one task."""
    df = spark.range(4000).select("id", F.lit(None).cast("bigint").alias("k"))
    lookup = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("x"))
    out = attach(df, lookup, ["k"], ["x"], size=10**12, spread_by=["id"])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 4000 and max(sizes) < 2000


@pytest.fixture
def no_small_broadcast(spark):
    """Spark broadcasts nothing by itself, so every lookup counts as large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("mode", [m for m in MODES if m != "broadcast"])
def test_a_large_lookup_shuffles_no_row(spark, workspace, no_small_broadcast, mode, null_safe):
    rows, table = lookup_case()
    df = spark.createDataFrame(rows, "id int, `k #` string")
    lookup = spark.createDataFrame(table, "`k #` string, w bigint, v bigint")
    limits = {**MODES[mode], "spread_by": ["id"], "workspace": workspace}
    got = attach(df, lookup, ["k #"], ["v"], null_safe=null_safe, **limits)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == ["id", "k #", "v"]
    values = {k: v for k, _, v in table if null_safe or k is not None}
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(i, values.get(k)) for i, k in rows]
    assert plan.count("Exchange hashpartitioning") == 1 and "Sort" not in plan  # the lookup's, not the rows'
    assert "ShuffledHashJoin" in plan


def test_a_large_lookup_by_numbers(spark, workspace, no_small_broadcast):
    """-0.0 is 0.0 and NaN is NaN, as in any join; a NULL part is compared too."""
    keys = [(0.0, 1), (-0.0, None), (float("nan"), 1), (None, 1), (None, None), (2.5, 7)]
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "id int, x double, y int")
    table = [(-0.0, 1, "a"), (0.0, None, "b"), (float("nan"), 1, "c"), (None, 1, "d"), (None, None, "e")]
    lookup = spark.createDataFrame(table, "x double, y int, v string")
    for null_safe, want in ((True, ["a", "b", "c", "d", "e", None]), (False, ["a", None, "c", None, None, None])):
        got = attach(df, lookup, ["x", "y"], ["v"], null_safe=null_safe, broadcast_bytes=0, hot_keys=1, workspace=workspace)
        assert [r["v"] for r in got.orderBy("id").collect()] == want


def test_dealing_leaves_the_session_as_it_was(spark, workspace):
    conf, tables = "spark.sql.maxConcurrentOutputFileWriters", spark.sql("SHOW TABLES").count()
    before = spark.conf.get(conf)
    df = spark.range(100).selectExpr("id % 7 AS `a b`", "id")
    got = workspace.deal(df, "dealt", ["a b"], 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get(conf) == before and spark.sql("SHOW TABLES").count() == tables

import random

import pytest
from pyspark.sql import functions as F

from tillstar.operators import joins


def skewed(spark, n=3000, keys=200, seed=5):
    """A fact with a third of its rows on one key, exact copies and null keys; and its dimension."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(keys)}"
        rows.append((key, i % 7, 1 if i % 2 else rng.randrange(5)))
    fact = spark.createDataFrame(rows, "k string, other int, n int")
    dim = spark.createDataFrame(
        [("hot", "H"), ("unused", "U")] + [(f"k{i}", f"v{i % 3}") for i in range(0, keys, 2)], "k string, v string"
    )
    return rows, fact, dim


def joined(rows, dim_rows):
    known = dict(dim_rows)
    return sorted((k, o, n, known[k]) for k, o, n in rows if k in known)


def test_hot_keys_are_few_and_found(spark):
    _, fact, _ = skewed(spark)
    assert [tuple(r) for r in joins.hot_keys(fact, "k", 300).collect()] == [("hot", 4)]
    assert joins.hot_keys(fact, "k", 1000).count() == 0
    every = {r.hot_key: r.shares for r in joins.hot_keys(fact, "k", 10).collect()}
    assert every["hot"] == 100 and None not in every and len(every) <= 300


@pytest.mark.parametrize("rows_per_task", [1, 10, 300, 10_000])
def test_lookup_is_the_inner_join(spark, no_broadcast, rows_per_task):
    rows, fact, dim = skewed(spark)
    got = joins.lookup(fact, dim, "k", rows_per_task)
    want = joined(rows, [tuple(r) for r in dim.collect()])
    assert sorted(tuple(r) for r in got.select("k", "other", "n", "v").collect()) == want


def test_repeated_dimension_keys(spark, no_broadcast):
    """A key that stands in the dimension twice finds both rows, hot or not."""
    rows, fact, dim = skewed(spark)
    got = joins.lookup(fact, dim.union(dim), "k", 300)
    want = joined(rows, [tuple(r) for r in dim.collect()])
    assert sorted(tuple(r) for r in got.select("k", "other", "n", "v").collect()) == sorted(want * 2)


def test_hot_rows_are_shared(spark, no_broadcast, tmp_path, plan_of):
    _, fact, dim = skewed(spark)
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    jobs = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    out = joins.lookup(fact, dim, "k", 100)
    assert plan_of(out).count("SortMergeJoin") == 1
    assert jobs() == before  # nothing runs while the plan is made
    out.collect()
    final = plan_of(out).split("== Initial Plan ==")[0]
    # The hot keys are counted once, for both sides.
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = out.groupBy("k", F.spark_partition_id()).count().where("k = 'hot'").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(hot) > 1 and sum(r["count"] for r in hot) == 1000


def test_counting_does_not_move_the_keys(spark, no_broadcast, plan_of):
    """Keys of which none is hot are counted in far fewer groups, not by themselves."""
    fact = spark.range(0, 200_000, 1, 2).select(F.concat(F.lit("key-"), F.col("id")).alias("k"), F.lit(1).alias("n"))
    dim = spark.range(0, 1_000, 1, 1).select(F.concat(F.lit("key-"), F.col("id")).alias("k"), F.col("id").alias("v"))
    out = joins.lookup(fact, dim, "k")
    initial = plan_of(out).split("== Initial Plan ==")[-1]
    counted = [line.split("hashpartitioning(")[1] for line in initial.splitlines() if "hashpartitioning(" in line and "hot_share" not in line]
    assert counted and all(line.startswith("key_group") for line in counted)
    assert out.count() == 1_000
    assert joins.GROUPED_ROWS // joins.ROWS_PER_TASK < 20_000


def test_groups_of_several_keys(spark, no_broadcast, monkeypatch):
    """Keys that share a group with a hot one are cut with it, and find all their rows."""
    monkeypatch.setattr(joins, "GROUPED_ROWS", 900)
    rows, fact, dim = skewed(spark)
    got = joins.lookup(fact, dim, "k", 300)
    assert sorted(tuple(r) for r in got.select("k", "other", "n", "v").collect()) == joined(rows, [tuple(r) for r in dim.collect()])


def test_keys_of_two_types(spark, no_broadcast):
    """Equal numbers of different types have different hashes; hot ones are found all the same."""
    fact = spark.createDataFrame([(7 if i % 2 else i,) for i in range(1000)], "k int")
    dim = spark.createDataFrame([(i, str(i)) for i in range(0, 1000, 7)], "k long, v string")
    want = sum((7 if i % 2 else i) % 7 == 0 for i in range(1000))
    assert joins.lookup(fact, dim, "k", 100).where("v = string(k)").count() == want


def test_small_dimension_is_broadcast_by_size(spark, tmp_path, plan_of):
    path = str(tmp_path / "dim")
    _, fact, dim = skewed(spark)
    dim.write.parquet(path)
    stored = spark.read.parquet(path)
    assert joins.broadcastable(stored)
    assert "BroadcastHashJoin" in plan_of(joins.lookup(fact, stored, "k"))


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_sum_then_lookup(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows, fact, dim = skewed(spark)
        got = joins.sum_then_lookup(fact, dim, "k", "n").groupBy("v").agg(F.sum("n").alias("n"))
        want: dict = {}
        for _, _, n, v in joined(rows, [tuple(r) for r in dim.collect()]):
            want[v] = want.get(v, 0) + n
        assert {r.v: r.n for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sum_comes_before_the_shuffle_join(spark, no_broadcast, plan_of):
    _, fact, dim = skewed(spark)
    text = plan_of(joins.sum_then_lookup(fact, dim, "k", "n"))
    assert "partial_sum" in text
    # One exchange per side: the join takes over the aggregate's partitioning.
    initial = text.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") == 2

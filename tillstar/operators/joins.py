"""Joins of the sales fact to its dimensions that stay even when keys are not.

A dimension is broadcast only where Spark's own size estimate puts it under
`spark.sql.autoBroadcastJoinThreshold`. Beyond that the fact has to shuffle, and
one key may hold a large share of its rows. Two exact ways keep that from landing
in one task: sum the fact per key first (`sum_then_lookup`), or, where rows must
stay rows, cut the keys that are hot into shares (`lookup`).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task may be left with.
ROWS_PER_TASK = 4_000_000
#: Rows up to which a group of keys (`lookup`) holds fewer, on average, than one task may be left with.
GROUPED_ROWS = 1 << 36


def broadcastable(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of `df` is under the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def hot_keys(fact: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task should get, and by how many tasks they are shared.

    `hot_key` and `shares`. Counted exactly, from the key column alone and folded per task
    before anything shuffles; there are at most as many such keys as tasks of that size.
    """
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > rows_per_task).select(
        "hot_key", F.ceil(F.col("n") / rows_per_task).cast("int").alias("shares")
    )


def lookup(fact: DataFrame, dim: DataFrame, key: str, rows_per_task: int | None = None) -> DataFrame:
    """Inner join of every fact row to the dimension rows of its key.

    Large dimension: keys are counted in groups of one hash, a number per group and task, as
    the keys themselves would be as many as the dimension's. A group with more rows than a
    task should get is cut into shares, by a hash of its rows, and only its dimension rows are
    repeated, once a share. The fact is read twice: its key column to count, and once for
    the join. The counts are part of the plan, worked out and broadcast when it runs; there
    is a row per task of the hot groups at most. Nothing runs while the plan is made.
    """
    if broadcastable(dim):
        return fact.join(dim, key)
    rows = rows_per_task or ROWS_PER_TASK
    group = F.col(key)
    if fact.schema[key].dataType == dim.schema[key].dataType:  # else equal keys may differ in their hash
        group = F.when(group.isNotNull(), F.pmod(F.xxhash64(group), F.lit(max(GROUPED_ROWS // rows, 1))))
    hot = F.broadcast(hot_keys(fact.select(group.alias("key_group")), "key_group", rows))
    columns = [F.col(f"`{c}`") for c in fact.columns]
    # Equal rows differ in their number, which a scan gives them alike each time.
    share = F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), "shares").cast("int")
    cut = fact.join(hot, group == F.col("hot_key"), "left").select(*columns, F.coalesce(share, F.lit(0)).alias("hot_share"))
    places = F.sequence(F.lit(0), F.coalesce(F.col("shares") - 1, F.lit(0)))
    repeated = dim.join(hot, group == F.col("hot_key"), "left").select(
        *(F.col(f"`{c}`") for c in dim.columns), F.explode(places).alias("hot_share")
    )
    return cut.join(repeated, [key, "hot_share"]).drop("hot_share")


def sum_then_lookup(fact: DataFrame, dim: DataFrame, key: str, *sums: str) -> DataFrame:
    """Join to the dimension where only sums of `sums` per dimension attribute matter.

    Large dimension: the fact is summed per key first. Map-side partial sums fold a
    hot key into one row per task, and the join reuses the aggregate's partitioning.
    """
    narrow = fact.select(key, *sums)
    if not broadcastable(dim):
        narrow = narrow.groupBy(key).agg(*(F.sum(s).alias(s) for s in sums))
    return narrow.join(dim, key)

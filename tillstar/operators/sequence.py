"""Order-dependent operators that never gather one ordered group in one task."""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.durations import whole_div
from ..session import scratch_path

BUCKET_MICROS = 60_000_000
PER_PARTITION_BITS = 33


def _buckets(moments: DataFrame, group: str, at: str) -> tuple[DataFrame, WindowSpec]:
    """Rows in one-minute buckets, and the window over one bucket in order of `at`.

    A bucket holds at most 60 million distinct microseconds and a year at most 527,040
    buckets, so neither ever is too much for a task, however the rows are spread. One
    shuffle serves all that is done per bucket. Rows without a group or a moment have
    no place in an order and are left out.
    """
    bucket = whole_div(F.col(at), F.lit(BUCKET_MICROS))
    placed = moments.withColumn("bucket", bucket).where(
        F.col(group).isNotNull() & F.col("bucket").isNotNull()
    )
    bucketed = placed.repartition(group, "bucket")
    return bucketed, Window.partitionBy(group, "bucket").orderBy(at)


def next_moment(moments: DataFrame, group: str, at: str) -> DataFrame:
    """Add `next_at`: LEAD of `at` within `group`, for distinct (group, at) rows.

    LEAD runs inside buckets; the last row of a bucket takes the first moment of the
    next bucket that has any.
    """
    bucketed, inside = _buckets(moments, group, at)
    across = Window.partitionBy(group).orderBy("bucket")
    heads = (
        bucketed.groupBy(group, "bucket").agg(F.min(at).alias("first_at"))
        .select(group, "bucket", F.lead("first_at").over(across).alias("after_bucket"))
    )
    return (
        bucketed.withColumn("inside_next", F.lead(at).over(inside))
        .join(heads, [group, "bucket"])
        .withColumn("next_at", F.coalesce("inside_next", "after_bucket"))
        .drop("bucket", "inside_next", "after_bucket")
    )


def gap_totals(moments: DataFrame, group: str, at: str, n: str) -> DataFrame:
    """Per group, the sum (`total`) and number (`gaps`) of LEAD minus current, over all rows.

    `moments` has distinct (group, at) rows that each stand for `n` equal ones, which
    follow each other with gap 0. Gaps inside a bucket are summed there; what is left
    is one row per bucket, and the gap from its end to the start of the next.
    """
    bucketed, inside = _buckets(moments, group, at)
    across = Window.partitionBy(group).orderBy("bucket")
    gap = F.lead(at).over(inside) - F.col(at)
    per_bucket = bucketed.withColumn("gap", gap).groupBy(group, "bucket").agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        F.sum("gap").alias("inside"), (F.sum(F.col(n) - 1) + F.count("gap")).alias("gaps"),
    )
    to_next = F.lead("first_at").over(across) - F.col("last_at")
    return per_bucket.withColumn("to_next", to_next).groupBy(group).agg(
        (F.coalesce(F.sum("inside"), F.lit(0)) + F.coalesce(F.sum("to_next"), F.lit(0))).alias("total"),
        (F.sum("gaps") + F.count("to_next")).alias("gaps"),
    )


def first_in_group(
    df: DataFrame, group: list[str], order: list[str], payload: list[str], **extra: Column
) -> DataFrame:
    """One row per group: the first by `order`, nulls last; ties fall to the smaller payload.

    `extra` aggregates of the whole group come from the same pass. A partial
    aggregate keeps one candidate per group and task, so no group is gathered.
    """
    null_last = [c for o in order for c in (F.col(o).isNull(), F.col(o))]
    first = F.min_by(F.struct(*order, *payload), F.struct(*null_last, *payload))
    named = [column.alias(name) for name, column in extra.items()]
    return df.groupBy(*group).agg(first.alias("first"), *named).select(*group, "first.*", *extra)


def with_index(df: DataFrame, *order: str, name: str = "index", path: str | None = None) -> DataFrame:
    """Add a dense 0-based row number in the given order, without a global window.

    Rows are range partitioned, sorted and numbered within their partition, and
    frozen as a table in the cluster's shared folder, so a lost executor cannot
    renumber them. The partitions' sizes, one row per partition, then give each
    partition its offset. A hash of the row and a row id break ties in `order`,
    so that rows which tie still spread out. The frozen table stands at `path`, for the
    caller to remove when the result has been used, or at a fresh one in the scratch space.
    """
    spark, columns = df.sparkSession, df.columns
    tied = df.withColumns({
        "tie_hash": F.xxhash64(*(F.col(f"`{c}`") for c in columns)),
        "tie_id": F.monotonically_increasing_id(),
    })
    keys = [F.asc_nulls_last(o) for o in order] + [F.col("tie_hash"), F.col("tie_id")]
    path = path or scratch_path(spark, "index")
    (
        tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie_hash", "tie_id")
        .withColumn("slot", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    frozen = spark.read.parquet(path).withColumn("part", F.shiftright("slot", PER_PARTITION_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("part").agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.col("slot").bitwiseAND(F.lit((1 << PER_PARTITION_BITS) - 1))
    return frozen.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + within).alias(name), *(F.col(f"`{c}`") for c in columns)
    )

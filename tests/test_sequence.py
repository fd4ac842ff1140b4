import random

import pytest
from pyspark.sql import functions as F

from tillstar.operators import sequence

MINUTE = 60_000_000


@pytest.mark.parametrize("seed", range(4))
def test_next_moment_is_lead(spark, seed):
    rng = random.Random(seed)
    spread = rng.choice([5, MINUTE, 50 * MINUTE, 10_000 * MINUTE])
    moments = {(g, rng.randrange(-spread, spread)) for g in ("a", "b", "c") for _ in range(150)} | {("one", 7)}
    df = spark.createDataFrame(sorted(moments, key=lambda _: rng.random()), "g string, at bigint")
    got = {(r.g, r.at): r.next_at for r in sequence.next_moment(df, "g", "at").collect()}
    ordered = sorted(moments)
    want = {
        (g, at): (ordered[i + 1][1] if i + 1 < len(ordered) and ordered[i + 1][0] == g else None)
        for i, (g, at) in enumerate(ordered)
    }
    assert got == want

    counted = df.withColumn("n", F.pmod(F.col("at"), F.lit(3)) + 1)
    totals = {r.g: (r.total, r.gaps) for r in sequence.gap_totals(counted, "g", "at", "n").collect()}
    for g in "a", "b", "c", "one":
        times = sorted(t for h, t in moments if h == g for _ in range(t % 3 + 1))
        assert totals[g] == (times[-1] - times[0], len(times) - 1)


def test_no_window_spans_a_group(spark, plan_of):
    df = spark.createDataFrame([("a", 1)], "g string, at bigint")
    windows = [x for x in plan_of(sequence.next_moment(df, "g", "at")).splitlines() if "Window [lead(at" in x]
    assert windows and all("bucket" in w for w in windows)


def test_first_in_group(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice("xyz"), rng.choice([None, "p1", "p2", "p10"]), rng.choice([None, "d1", "d2"]), rng.randrange(9))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "g string, p string, d string, q int")
    got = sequence.first_in_group(df, ["g"], ["p", "d"], ["q"], total=F.sum("q"))
    assert got.columns == ["g", "p", "d", "q", "total"]
    key = lambda r: (r[1] is None, r[1] or "", r[2] is None, r[2] or "", r[3])
    for r in got.collect():
        group = [x for x in rows if x[0] == r.g]
        assert (r.g, r.p, r.d, r.q) == min(group, key=key) and r.total == sum(x[3] for x in group)


@pytest.mark.parametrize("distinct", [1, 3, 500])
def test_index_is_dense_and_ordered(spark, distinct):
    rows = [(i * 7919 % 500 % distinct, "copy") for i in range(500)] + [(None, "last")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    got = sequence.with_index(df, "k").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(501))
    assert [r.k for r in got] == sorted(k for k, _ in rows[:-1]) + [None]


def test_index_of_an_empty_table(spark):
    assert sequence.with_index(spark.createDataFrame([], "k int"), "k").count() == 0


def test_tied_rows_spread_over_tasks(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        indexed = sequence.with_index(df, "k")
    finally:
        spark.conf.set(coalesce, "true")
    assert len([f for f in indexed.inputFiles() if "part-" in f]) > 1
    assert indexed.agg(F.max("index")).first()[0] == 19_999

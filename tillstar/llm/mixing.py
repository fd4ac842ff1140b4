"""Mixing sources to target weights by entropy balancing.

Every word is to be taken at a rate r. Among all rates that meet the token constraints
(the words taken of a source, or of any other grouping of the documents, add up to a
target), those are chosen that stay closest to one in relative entropy over the words.
The convex dual of that has one multiplier per constraint, and its solution is an
exponential tilt: the rate of a document is the exponential of the sum of its groups'
multipliers. Newton's method finds them: each round, Spark adds up the gradient and the
Hessian over the cells of documents that share their groups; the driver solves a linear
system as large as the number of constraints.

Rates become copies by carrying the rounding error on. Per source, the documents of one
size get as many copies in all as come nearest to what their rates and the error so far
ask for; sizes run from large to small, so what is left at the end is about one small
document. A source's distinct sizes number at most about the square root of twice its
words, which bounds the rows that one task steps through. Inside a size, copies go to
documents in the order of a hash, so that reruns agree, by counts per bucket and a row
number inside each.

Null texts have size 0. Documents of size 0 take part in nothing and keep one copy; it
has no words. Rows that repeat get their copies each for itself. Null is a source like
any other, in order after all others. An empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import free_name, spread, written

WEIGHTS = (5, 2, 1)
MOST = 3
ROUNDS = 50
TOLERANCE = 1e-10
BUCKETS = 256


def word_count(text: str | Column) -> Column:
    """Words (runs without ASCII white space) of a text; null: 0."""
    plain = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.coalesce(F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.translate(plain, " ", "")) + 1), F.lit(0)).cast("long")


def share_out(sizes: dict, weights: dict, most: float = MOST) -> dict:
    """Targets that share the sum of all sizes by weight, none over `most` times its size;
    what is over is shared again among the others, until none is above."""
    targets, open_ = {}, set(sizes)
    left = float(sum(sizes.values()))
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > most * sizes[s]}
        if not over:
            return targets | {s: left * weights[s] / total for s in open_}
        targets |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return targets


def cycled_weights(sources, weights=WEIGHTS) -> dict:
    """Weights dealt out in turn to the sources by code point, null last."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(order)}


def balance(cells: DataFrame, targets: list[tuple[str, dict]], size: str = "size") -> list[dict]:
    """Multipliers, one dict per constraint column, whose exponentials' product is the rate.

    `cells` has a row per combination of the columns with its words in `size`; each
    column comes with the target of each of its values. Values with no words or no target
    have no multiplier (their rate is left as it is, or zero).
    """
    index = {(c, v): i for i, (c, v) in enumerate((c, v) for c, wanted in targets for v, t in wanted.items() if t > 0)}
    aim = np.array([dict(targets)[c][v] for c, v in index])
    spark = cells.sparkSession
    multiplier = np.zeros(len(index))
    for _ in range(ROUNDS if len(index) else 0):
        exponent, here = F.lit(0.0), cells
        for c, wanted in targets:
            rows = [(v, index[c, v], float(multiplier[index[c, v]])) for v in wanted if (c, v) in index]
            at, by = free_name(here.columns, f"at_{c}"), free_name(here.columns, f"by_{c}")
            value = free_name(here.columns, f"value_{c}")
            table = spark.createDataFrame(rows, f"`{value}` {cells.schema[c].dataType.simpleString()}, `{at}` int, `{by}` double")
            here = here.join(table, here[c].eqNullSafe(table[value]), "left").drop(value)
            exponent = exponent + F.coalesce(F.col(by), F.lit(0.0))
        places = F.array_compact(F.array(*[F.col(x) for x in here.columns if x.startswith("at_")]))
        taken = here.select(places.alias("places"), (F.col(size) * F.exp(exponent)).alias("words")).groupBy("places").agg(F.sum("words").alias("words"))
        gradient, hessian = -aim, np.zeros((len(aim), len(aim)))
        for r in taken.collect():  # as many rows as combinations of constraints
            for i in r["places"]:
                gradient[i] += r["words"]
                for j in r["places"]:
                    hessian[i, j] += r["words"]
        if np.max(np.abs(gradient) / np.maximum(aim, 1.0)) < TOLERANCE:
            break
        step = np.linalg.lstsq(hessian, -gradient, rcond=None)[0]
        multiplier = multiplier + np.clip(step, -2.0, 2.0)  # damped far from the solution
    return [{v: float(multiplier[index[c, v]]) for v in wanted if (c, v) in index} for c, wanted in targets]


def _copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies per size of one source (origin, size, n, rate, most), from large to small,
    carrying the error on."""
    rows = rows.sort_values("size", ascending=False, ignore_index=True)
    owed, out = 0.0, []
    for size, n, rate, most in zip(rows["size"], rows["n"], rows["rate"], rows["most"], strict=True):
        owed += rate * size * n
        total = min(max(math.floor(owed / size + 0.5), 0), int(most * n))
        owed -= total * size
        out.append(total)
    rows["copies"] = np.array(out, dtype=np.int64)
    return rows[["origin", "size", "n", "copies"]]


def mix(
    df: DataFrame, weights=WEIGHTS, id: str = "doc_id", text: str = "text", source: str = "source", most: int = MOST
) -> DataFrame:
    """One row per row of `df`: id, text_key (a hash of the text), source, size, source_size,
    target (its source's words wanted) and copies (0 to `most`)."""
    spark = df.sparkSession
    # origin: the source as a key that is never null
    origin = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    docs = written(
        df.select(F.col(id).alias("id"), F.xxhash64(text).alias("key"), origin.alias("origin"), word_count(text).alias("size"))
        .withColumn("bucket", spread("id", "key", buckets=BUCKETS)),
        "sizes",
    )
    groups = written(docs.groupBy("origin", "size", "bucket").agg(F.count("*").alias("n")), "groups")
    cells = written(groups.groupBy("origin").agg(F.sum(F.col("size") * F.col("n")).alias("size")), "cells")
    sizes = {r["origin"]: r["size"] for r in cells.collect()}  # a row per source
    named = {o[1:] if o else None: o for o in sizes}
    dealt_out = cycled_weights(named, weights)
    targets = share_out(sizes, {o: dealt_out[s] for s, o in named.items()}, most)
    (multipliers,) = balance(cells, [("origin", targets)])
    rates = spark.createDataFrame(
        [(o, s, sizes[o], targets[o], math.exp(multipliers[o]) if o in multipliers else 0.0) for s, o in named.items()],
        "origin string, source string, source_size long, target double, rate double",
    )

    per_size = groups.where("size > 0").groupBy("origin", "size").agg(F.sum("n").alias("n"))
    wanted = per_size.join(rates, "origin").select("origin", "size", "n", "rate", F.lit(most).alias("most"))
    copies = written(wanted.groupBy("origin").applyInPandas(_copies, "origin string, size long, n long, copies long"), "copies")
    # Of each size, all get copies // n, and as many as are left one more: the first by
    # bucket, and inside a bucket by hash.
    below = Window.partitionBy("origin", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).drop("n")
    shares = before.join(copies, ["origin", "size"]).select(
        "origin", "size", "bucket", F.expr("copies div n").alias("each"), (F.col("copies") % F.col("n") - F.col("before")).alias("more")
    )
    row = F.row_number().over(Window.partitionBy("origin", "size", "bucket").orderBy(F.xxhash64("id", "key"), "id", "key"))
    dealt = docs.withColumn("row", row).join(shares, ["origin", "size", "bucket"], "left")
    number = F.when(F.col("size") == 0, 1).otherwise(F.col("each") + (F.col("row") <= F.col("more")).cast("long"))
    return dealt.join(rates, "origin").select(
        F.col("id").alias(id), F.col("key").alias(free_name([id, source], "text_key")), F.col("source").alias(source),
        "size", "source_size", "target", number.cast("int").alias("copies"),
    )


def mixed(df: DataFrame, weights=WEIGHTS, id: str = "doc_id", text: str = "text", source: str = "source", most: int = MOST) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it."""
    a, b, c, n, rows = (free_name(df.columns, x) for x in ("mix_id", "mix_key", "mix_source", "mix_copies", "mix_rows"))
    dealt = mix(df, weights, id, text, source, most)
    # Rows that repeat id, text and source have copies of their own: added up here.
    total = written(
        dealt.groupBy(F.col(id).alias(a), F.col(free_name([id, source], "text_key")).alias(b), F.col(source).alias(c))
        .agg(F.sum("copies").alias(n), F.count("*").alias(rows)),
        "copies",
    )
    same = F.col(id).eqNullSafe(F.col(a)) & (F.xxhash64(text) == F.col(b)) & F.col(source).eqNullSafe(F.col(c))

    def repeated(some: DataFrame, times: Column) -> DataFrame:
        return some.withColumn(n, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*df.columns)

    out = repeated(df.join(total.where((F.col(rows) == 1) & (F.col(n) > 0)), same), F.col(n))
    several = total.where((F.col(rows) > 1) & (F.col(n) > 0))
    if several.isEmpty():
        return out
    place = F.row_number().over(Window.partitionBy(a, b, c).orderBy(F.lit(0)))
    times = F.expr(f"`{n}` div `{rows}`") + (place <= F.col(n) % F.col(rows)).cast("long")
    at = free_name([*df.columns, n, rows], "mix_times")
    return out.union(repeated(df.join(several, same).withColumn(at, times), F.col(at)))

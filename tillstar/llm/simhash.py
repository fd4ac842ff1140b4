"""SimHash near-dedup: segment popcounts as a lower bound of the bit distance.

A fingerprint holds, bit by bit, the majority of its shingles' hashes. Fingerprints link
at `BITS` or fewer differing bits. To find the links without comparing all pairs, a
fingerprint is embedded as 32 counters, the set bits in each two-bit segment. Flipping a
bit moves one counter by one, so the Manhattan distance between two embeddings never
exceeds the bit distance. Split into two halves of 16 counters, a linked pair has a half
at distance two or less, and then some grid point lies within one step of both. So every
fingerprint is put into the cells within one step of it, in either half; the range join
is an equi-join on cells, and each candidate pair is verified on its bits, in one cell
alone (the first step from the smaller towards the larger fingerprint).

Exact copies share a fingerprint and meet as one row. A cell of more than `CELL_ROWS`
fingerprints isn't paired up but cut by a finer grid over counters that it leaves free: of
its members' other half, of 16 counters at distance four or less, one of the two quarters is
at distance two or less, so the same steps apply to eight counters; and once more to four of
the remaining eight. What is crowded even then are near copies of each other. Those are put
under all fingerprints within two bits of them (2,081 keys): two such sets meet exactly
where the distance is four or less, so joining each member to the least of its key finds the
same components without writing out all pairs of such a crowd.

Null and empty texts have fingerprint zero, linked like any other; rows with a null id
get a component of null unless a row with an id reaches them; an empty table gives an
empty one.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillstar.llm.common import components, free_name, with_text_column, written

WORDS = 4
BITS = 4
CELL_ROWS = 1024
SEED = 42


def fingerprint(text: str, words: int = WORDS) -> int:
    """The 64-bit fingerprint as a signed number."""
    found = text.encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in found))
        hashes = [
            xxhash.xxh64_intdigest(joined[a : b - 1], SEED)
            for a, b in zip([0, *ends], ends[words - 1 :], strict=False)
        ]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounds the memory of very long texts
        part = np.array(hashes[at : at + 65536], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", words: int = WORDS) -> tuple[DataFrame, str]:
    """`df` with a column of fingerprints, and that column's name."""
    return with_text_column(df, text, "fingerprint", LongType(), lambda: lambda texts: [fingerprint(t, words) for t in texts])


def _counters(fp: Column, offset: Column, bits: int) -> Column:
    """The set bits of each two-bit segment of `bits` bits from `offset` on, as two-bit numbers."""
    part = F.call_function("shiftrightunsigned", fp, offset).bitwiseAND(F.lit((1 << bits) - 1))
    return part - F.shiftright(part, 1).bitwiseAND(F.lit(0x5555555555555555 & (1 << bits) - 1))


def _cells(center: Column, bits: int) -> Column:
    """The grid points within one step of the counters; steps that leave 0..2 are null."""
    points = [center]
    for j in range(0, bits, 2):
        counter = F.shiftright(center, j).bitwiseAND(F.lit(3))
        points += [F.when(counter < 2, center + F.lit(1 << j)), F.when(counter > 0, center - F.lit(1 << j))]
    return F.array_compact(F.array(*points))


def _meeting(a: Column, b: Column) -> Column:
    """The one cell where a pair of counters is verified: `a`, moved one step towards `b` in
    the lowest counter in which they differ."""
    differ = a.bitwiseXOR(b)
    low = differ.bitwiseAND(-differ)
    counter = F.floor(F.bit_count(low - 1) / 2).cast("int") * 2
    shift = lambda x: F.call_function("shiftright", x, counter).bitwiseAND(F.lit(3))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), counter)
    return F.when(differ == 0, a).when(shift(a) < shift(b), a + step).otherwise(a - step)


def _within_two(fp: Column) -> Column:
    """All 2,081 numbers at two or fewer bits from `fp`."""
    one = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    masks = [0, *one, *(x ^ y for i, x in enumerate(one) for y in one[:i])]
    return F.transform(F.lit(masks), lambda m: m.bitwiseXOR(fp))


def _gridded(members: DataFrame, bits: int, parts: int) -> DataFrame:
    """Members (fp, key, rest) in the cells of either part of their `2 * bits` bits from `rest` on:
    fp, key (of the old one, the part and the cell), rest (what the part leaves), center and cell."""
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    split = members.select("fp", "key", "rest", sides).select(
        "fp", "key", "side", (F.col("rest") + (1 - F.col("side")) * bits).alias("rest"),
        _counters(F.col("fp"), F.col("rest") + F.col("side") * bits, bits).alias("center"),
    )
    cells = split.select("fp", "key", "side", "rest", "center", F.explode(_cells(F.col("center"), bits)).alias("cell"))
    return cells.select("fp", F.xxhash64("key", "side", "cell").alias("key"), "rest", "center", "cell").repartition(parts, "key")


def _met(cells: DataFrame, bits: int) -> DataFrame:
    """Linked pairs (a, b) within cells."""
    left = cells.select("key", F.col("fp").alias("a"), F.col("center").alias("ca"), "cell")
    right = cells.select(F.col("key").alias("other"), F.col("fp").alias("b"), F.col("center").alias("cb"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    once = F.col("cell") == _meeting(F.col("ca"), F.col("cb"))
    return left.join(right, (F.col("key") == F.col("other")) & (F.col("a") < F.col("b")) & near & once).select("a", "b")


def links(prints: DataFrame, fp: str = "fp", bits: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect whatever is linked.

    `prints` holds each fingerprint once. Pairs that meet in a cell of up to `cell_rows`
    fingerprints, of the coarse grid or of a finer one, are all there; in crowds of near
    copies each is joined to the least one it shares a midpoint with, which has the same
    components.
    """
    if bits > 4:
        raise ValueError("the grid's parts and single steps cover up to four bits")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = prints.select(F.col(fp).alias("fp"), F.lit(0).cast("long").alias("key"), F.lit(0).alias("rest"))
    found = None
    for width in (32, 16, 8):
        cells = _gridded(members, width, parts)
        crowded = written(cells.groupBy("key").count().where(F.col("count") > cell_rows).select("key"), "crowded")
        none = crowded.isEmpty()
        pairs = _met(cells if none else cells.join(crowded, "key", "left_anti"), bits)
        found = pairs if found is None else found.union(pairs)
        if none:
            return found.distinct()
        members = written(cells.join(crowded, "key", "left_semi").select("fp", "key", "rest"), "members")
    if bits != 4:
        raise ValueError("crowds are linked by midpoints, which give exactly four bits")
    crowd = members.select("fp").distinct().repartition(parts, "fp")
    keys = crowd.select("fp", F.explode(_within_two(F.col("fp"))).alias("key"))
    least = keys.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a != top")
    star = keys.join(least, "key").where("fp != a").select("a", F.col("fp").alias("b"))
    return found.union(star).distinct()


def _classified(df: DataFrame, id: str, text: str, words: int, bits: int, cell_rows: int) -> DataFrame:
    """(id, key, fp, component, component_id) for each row; key is a hash of the text."""
    printed, at = with_fingerprint(df.select(id, text), text, words)
    prints = written(printed.select(F.col(id).alias("id"), F.xxhash64(text).alias("key"), F.col(at).alias("fp")), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    reach = components(links(classes.select("fp"), "fp", bits, cell_rows))
    labelled = classes.join(reach.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp")


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """One row per row of `df`: its id, its fingerprint (a signed long) and component_id,
    the smallest id that links reach from it."""
    found = _classified(df, id, text, words, bits, cell_rows)
    return found.select(F.col("id").alias(id), F.col("fp").alias("fingerprint"), "component_id")


def keep_one_of_each(
    df: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS
) -> DataFrame:
    """The rows of `df` without near duplicates: of each component the row of the smallest
    id stays. Rows without an id stay only where no row of their component has one; rows
    that repeat id and text stay once."""
    found = written(_classified(df, id, text, words, bits, CELL_ROWS).select("id", "key", "component"), "found")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "key")).alias("best"))
    name, key = free_name(df.columns, "best_id"), free_name(df.columns, "best_key")
    chosen = best.select(F.col("best.id").alias(name), F.col("best.key").alias(key))
    same = F.col(id).eqNullSafe(F.col(name)) & (F.xxhash64(text) == F.col(key))
    repeated = found.groupBy("id", "key").count().where("count > 1").select(F.col("id").alias(name), F.col("key").alias(key))
    kept = df.join(chosen, same, "left_semi")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = (
        df.join(chosen, same, "left_semi").join(repeated, same, "left_semi")
        .groupBy(F.col(id).alias(name), F.xxhash64(text).alias(key)).agg(F.min(row).alias("row"))
        .select(*[F.col("row")[c].alias(c) for c in df.columns])
    )
    return kept.join(repeated, same, "left_anti").union(first)

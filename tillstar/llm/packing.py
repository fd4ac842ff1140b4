"""Best-fit packing of token sequences by exact complements.

Documents become pieces of at most `size` tokens. How pieces are combined depends on
their lengths alone, and there are at most `size` of these, so the plan is made from
counts per length: from the longest length down, each remaining piece leaves a gap that
is filled exactly by a single length, a pair or a triple (an index of single and pair
sums over the lengths still available), and a combination is used as often as its counts
allow. What has no exact complement is placed best-fit: longest first, into the smallest
gap that holds it. Of the plans with triples, with pairs and with single fillers only, the
shortest is taken. The plan is a list of patterns with their numbers of uses; its size
depends on `size`, not on the data.

Pieces are matched to places by their rank within their length, which comes from counts
per (length, bucket) and a row number inside the bucket, so that one common length is no
one task's work. Nothing but the counts per length reaches the driver.

Token ids are those of the `tokenizers` file named by the caller. The work is done by
`tiktoken` over the same vocabulary, which gives the same ids about three times as fast;
texts that hold the name of a special token go to `tokenizers` itself.

Null and empty texts are one piece (the closing id). Repeated rows are packed each for
itself. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections import defaultdict
from itertools import accumulate
from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tillstar.llm.common import free_name, spread, with_text_column, written

SIZE = 1024
END = 2
BUCKETS = 1024

PIECE = StructType([
    StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()),
    StructField("ids", BinaryType()), StructField("ids_crc32", LongType()),
])


@functools.cache
def _encoder(vocabulary: str, ranks: str | None):
    """Texts to ids; made once per worker process."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary)
    slow = lambda text: plain.encode(text, add_special_tokens=False).ids
    if ranks is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    quick = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    special = {t.content: i for i, t in plain.get_added_tokens_decoder().items()}
    marks = re.compile("|".join(map(re.escape, special))) if special else None

    def encode(text: str) -> list[int]:
        return slow(text) if marks and marks.search(text) else quick.encode_ordinary(text)

    return encode


def cut(ids: list[int], size: int, keep_ids: bool) -> list[tuple]:
    """Pieces of a document's ids: all of `size`, but for the first, which may be shorter."""
    data = array("I", ids)
    first = len(ids) % size or size
    starts = [0, *range(first, len(ids), size)]
    out = []
    for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
        raw = data[a:b].tobytes()
        out.append((n, a, b - a, raw if keep_ids else None, crc32(raw)))
    return out


def pieces(
    df: DataFrame, vocabulary: str, ranks: str | None = None, id: str = "doc_id", text: str = "text",
    size: int = SIZE, end: int = END, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian 32-bit), ids_crc32."""

    def make():
        encode = _encoder(vocabulary, ranks)
        return lambda texts: [
            [dict(zip(PIECE.names, p, strict=True)) for p in cut([*encode(t), end], size, keep_ids)] for t in texts
        ]

    cutup, at = with_text_column(df.select(id, text), text, "pieces", ArrayType(PIECE), make)
    kept = [c for c in PIECE.names if keep_ids or c != "ids"]
    one = free_name([id], "one")
    return cutup.select(id, F.explode(at).alias(one)).select(id, *[F.col(one)[c].alias(c) for c in kept])


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (number of uses, lengths) that use up `counts` pieces per length.

    Filling gaps by triples uses up short pieces that later ones may lack, so plans with up
    to three, two and one fillers are made, and the one with the fewest sequences is taken.
    """
    return min((_plan(counts, size, most) for most in (3, 2, 1)), key=lambda p: sum(times for times, _ in p))


def _plan(counts: dict[int, int], size: int, most: int) -> list[tuple[int, tuple[int, ...]]]:
    left = {n: c for n, c in counts.items() if c > 0}
    patterns: list[tuple[int, tuple[int, ...]]] = []

    def use(parts: tuple[int, ...]) -> None:
        need = {n: parts.count(n) for n in parts}
        times = min(left[n] // k for n, k in need.items())
        patterns.append((times, parts))
        for n, k in need.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]

    def enough(*parts: int) -> bool:
        return all(left.get(n, 0) >= parts.count(n) for n in parts)

    rest: dict[int, int] = {}
    while left:
        top = max(left)
        parts = (top,) if top == size else _complement(top, size - top, left, enough, most)
        if parts:
            use(parts)
        else:
            rest[top] = left.pop(top)
    return patterns + _best_fit(rest, size)


def _complement(top: int, gap: int, left: dict[int, int], enough, most: int) -> tuple[int, ...] | None:
    """Lengths that fill `gap` exactly beside `top`: one, two or three (`most` at most), the
    longest first."""
    if enough(top, gap):
        return (top, gap)
    if most < 2:
        return None
    order = sorted((n for n in left if n < gap), reverse=True)
    for a in order:
        if 2 * a < gap:
            break
        if enough(top, a, gap - a):
            return (top, a, gap - a)
    for a in order if most > 2 else ():
        if 3 * a < gap:
            break
        for b in order:
            c = gap - a - b
            if b > a or c <= 0:
                continue
            if c > b:
                break
            if enough(top, a, b, c):
                return (top, a, b, c)
    return None


def _best_fit(rest: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Longest first into the smallest gap that holds it, on groups of equal sequences."""
    open_: dict[int, list[list]] = defaultdict(list)  # gap -> groups of [uses, parts]
    for n in sorted(rest, reverse=True):
        count = rest[n]
        while count:
            gap = min((g for g, groups in open_.items() if g >= n and groups), default=None)
            if gap is None:
                fit = size // n
                if count >= fit:
                    open_[size - fit * n].append([count // fit, (n,) * fit])
                    count %= fit
                else:
                    open_[size - count * n].append([1, (n,) * count])
                    count = 0
                continue
            group = open_[gap].pop()
            times = min(count, group[0])
            if group[0] > times:
                open_[gap].append([group[0] - times, group[1]])
            open_[gap - n].append([times, (*group[1], n)])
            count -= times
    return [(times, parts) for groups in open_.values() for times, parts in groups]


def pack(cut_pieces: DataFrame, id: str = "doc_id", size: int = SIZE) -> DataFrame:
    """The pieces with sequence_id and offset: no sequence over `size`, no gaps inside.

    `cut_pieces` comes from `pieces`; it is read several times, so a written table serves best.
    """
    spark = cut_pieces.sparkSession
    order = [F.col(id), F.col("piece"), F.col("ids_crc32")]
    placed = cut_pieces.withColumn("bucket", spread(*order, buckets=BUCKETS))
    shares = written(placed.groupBy("length", "bucket").count(), "lengths")
    counts = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    # Ranks below a bucket: at most BUCKETS rows for each length.
    below = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shares.select("length", "bucket", F.coalesce(F.sum("count").over(below), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order))
    ranked = (
        placed.withColumn("row", inside.cast("long")).join(firsts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("row") - 1)
    )

    slots, used, sequence = [], defaultdict(int), 0
    for times, parts in plan(counts, size):
        for n, offset in zip(parts, [0, *accumulate(parts)], strict=False):
            slots.append((n, used[n], used[n] + times, sequence - used[n], offset))
            used[n] += times
        sequence += times
    # As large as the plan: some thousand rows at the default size, whatever the input.
    table = spark.createDataFrame(slots, "n long, low long, high long, shift long, offset long")
    fits = (F.col("length") == F.col("n")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked.join(F.broadcast(table), fits).select(
        *cut_pieces.columns, (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset"
    )

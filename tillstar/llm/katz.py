"""Katz backoff language model: discounted n-gram counts, scored recursively per token.

A text is its lower-cased words and an end, after a begin mark that is only ever context.
Of the learned texts, an n-gram's probability after its context h is its count, discounted
after Good and Turing, over the count of h. An n-gram that wasn't met gets that of the
shorter one, times h's backoff weight: the mass that discounting left to h over the mass
that the shorter n-grams have beyond the words met after h, so that the probabilities after
any context sum to one exactly. At the bottom stands one unknown word with the mass that
single words left.

Counts of up to `k` are discounted by Katz's formula; `k` is lowered where the counts of
counts give no discount between 0 and 1, and where none does, every count loses a half. A
context that has larger counts only would keep no mass at all; so larger counts lose as
much as the least that a smaller one loses. Every weight is positive then.

How it runs. Texts are dealt into blocks of `BLOCK_TOKENS` tokens, written once as numbers
of a block's own words. Each block asks for each of its n-grams once, as sorted 64-bit
hashes in buckets by hash, with its own learned count. A bucket sums the counts, tells every
block, and names one block the owner of an n-gram. The blocks then know all that a token's
probability needs but the backoff weights; what an n-gram takes away from its context's
weight is added up by its owner. Weights are sums over owners, in a table by context, and
are joined to what the texts ask for: contexts asked for by many texts (at most `HOT`) by
broadcast. However frequent an n-gram or a context, it is one entry a block. A bucket and a
block have a bounded number of n-grams, so tasks grow in number, not in memory. What there is
one of for each token is held for `SLICE_TOKENS` of a block at a time, and rows leave a block
as they are made. Two different n-grams are taken for one where their hashes collide: about
n / 2**64 of n n-grams.

Null and empty texts are an end alone; repeated rows count and are scored each for itself;
rows whose `train` is null are learned from; an empty table gives an empty one; without any
learned text every token is the unknown word with probability one. Further columns are left
out.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tillstar.llm.common import LARGE_ROWS, written

ORDER = 2
K = 5
#: Tokens in a block, about (one text is never split), and n-grams asked for in a bucket.
BLOCK_TOKENS, BUCKET_GRAMS = 1 << 20, 1 << 20
#: Tokens of a block that are looked at together, about, and rows that leave it together, at most.
SLICE_TOKENS, ROWS = 1 << 17, 1 << 15
#: Texts that are Python strings at a time, at most.
TEXTS = 256
#: Contexts that are broadcast, at most: those asked for by more than 1 / HOT of all askers.
HOT = 1000
SEED = 42
BEGIN, END = 0, 1
#: What no word is.
MARKS = {b" ": BEGIN, b"\n": END}


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of all of them, compressed."""
    columns = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(columns.tobytes())


def unpack(data: bytes) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).view("<u8").reshape(-1)


def pack_sorted(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, order mattering."""
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slice:
    """Some texts of a block as numbers of their words; text i is BEGIN, its words, END."""

    def __init__(self, hashes: np.ndarray, stream: np.ndarray, train: np.ndarray, order: int):
        begin = stream == BEGIN
        self.text = np.cumsum(begin, dtype=np.int32) - 1
        self.place = np.arange(len(stream), dtype=np.int32) - np.flatnonzero(begin).astype(np.int32)[self.text]
        self.train = train
        #: Of each length the hash of the n-gram that ends at a place; not of all places.
        words = hashes[stream]
        self.keys = {1: words}
        for m in range(2, order + 1):
            self.keys[m] = np.concatenate([np.zeros(1, np.uint64), mixed(self.keys[m - 1][:-1], words[1:])])

    def ends(self, m: int) -> np.ndarray:
        """Whether an n-gram of length m ends at a place."""
        return self.place >= max(1, m - 1)

    def distinct(self, m: int) -> np.ndarray:
        """The hashes of length m, sorted, each once."""
        return _once(np.sort(self.keys[m][self.ends(m)]))

    def asked(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of length m and their learned counts."""
        distinct = self.distinct(m)
        learned = np.sort(self.keys[m][self.ends(m) & self.train[self.text]])
        return distinct, (np.searchsorted(learned, distinct, "right") - np.searchsorted(learned, distinct, "left")).astype(np.uint64)


def _once(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)]]


def _blocks(schema: pa.Schema):
    """A function from Arrow batches (id, text, train) to a row per block."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        number, ids, train, streams, tokens = None, [], [], [], 0

        def full() -> pa.RecordBatch:
            hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in number], np.uint64)
            row = {
                "block": (part << 32) + turn, "ids": ids, "train": train, "tokens": tokens,
                "words": pack(hashes), "stream": zstandard.ZstdCompressor(level=1).compress(np.concatenate(streams).tobytes()),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for some in (batch.slice(i, TEXTS) for batch in batches for i in range(0, batch.num_rows, TEXTS)):
            for i, text, learned in zip(*(c.to_pylist() for c in some.columns), strict=True):
                if number is None:
                    number = defaultdict(None, MARKS)
                    number.default_factory = number.__len__
                words = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
                line = np.empty(len(words) + 2, np.uint32)
                line[0], line[-1] = BEGIN, END
                line[1:-1] = [number[w] for w in words]
                ids.append(i)
                train.append(learned)
                streams.append(line)
                tokens += len(line)
                if tokens >= BLOCK_TOKENS:
                    yield full()
                    number.default_factory = None  # else it would hold itself
                    number, ids, train, streams, tokens, turn = None, [], [], [], 0, turn + 1
        if ids:
            yield full()

    return run


def _slices(row: dict, order: int) -> Iterator[tuple[int, Slice]]:
    """A block's texts, about SLICE_TOKENS at a time, and the number of the first."""
    stream = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["stream"]), np.uint32)
    hashes, train = unpack(row["words"]), np.array(row["train"], bool)
    begin = np.flatnonzero(stream == BEGIN)
    cut = np.flatnonzero(np.diff(begin // SLICE_TOKENS, prepend=-1))
    for i, j in zip(cut, [*cut[1:], len(begin)], strict=True):
        yield int(i), Slice(hashes, stream[begin[i] : begin[j] if j < len(begin) else None], train[i:j], order)


def _edges(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted hashes begins; the last entry is their number."""
    bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, bounds), [len(distinct)]])


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """All that is in any of the parts, sorted, each once."""
    return _once(np.sort(np.concatenate(parts)))


def _asks(order: int, buckets: int):
    """A function from blocks to (length, bucket, block, hashes, counts)."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one at a time: a row is a block
                row = batch.slice(k, 1).to_pylist()[0]
                parts = {m: [] for m in range(1, order + 1)}
                for _, texts in _slices(row, order):
                    for m in parts:
                        parts[m].append(texts.asked(m))
                for m in range(1, order + 1):
                    distinct = _merged([d for d, _ in parts[m]])
                    counts = np.zeros(len(distinct), np.uint64)
                    for d, c in parts.pop(m):
                        counts[np.searchsorted(distinct, d)] += c
                    edges = _edges(distinct, buckets)
                    out = [
                        {"m": m, "bucket": b, "block": row["block"], "hashes": pack_sorted(distinct[i:j]), "counts": pack(counts[i:j])}
                        for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j
                    ]
                    del distinct, counts
                    yield pa.RecordBatch.from_pylist(out, schema=ASK)

    return run


ASK = pa.schema([("m", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
ANSWER = pa.schema([("m", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _answer(table: pa.Table) -> pa.Table:
    """Of a bucket's asks: for each, twice the total count of each hash, plus one where the
    asking block owns it; and a row of statistics: distinct n-grams met, their total, and how
    many were met once, twice, up to K + 1 times."""
    rows = table.to_pylist()
    hashes = [unpack_sorted(r["hashes"]) for r in rows]
    counts = np.concatenate([unpack(r["counts"]) for r in rows]).astype(np.int64)
    distinct = _once(np.sort(np.concatenate(hashes)))
    which = np.concatenate([np.searchsorted(distinct, h) for h in hashes])
    total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
    first = np.full(len(distinct), -1)
    met = np.flatnonzero(counts)[::-1]
    first[which[met]] = met  # the first that has met it is assigned last
    reply = 2 * total[which] + (first[which] == np.arange(len(which)))
    out, at = [], 0
    for r, h in zip(rows, hashes, strict=True):
        out.append({k: r[k] for k in ("m", "bucket", "block")} | {"counts": pack(reply[at : at + len(h)])})
        at += len(h)
    stats = [np.count_nonzero(total), total.sum(), *np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2]]
    out.append({"m": rows[0]["m"], "bucket": rows[0]["bucket"], "stats": [int(x) for x in stats]})
    return pa.Table.from_pylist(out, schema=ANSWER)


def discounts(met: list[int], k: int = K) -> list[float]:
    """What share of itself a count of 1, 2, ... keeps, given how many n-grams were met once,
    twice, up to k + 1 times."""
    n = dict(enumerate(met, 1))
    for top in range(k, 0, -1):
        if all(n.get(r) for r in range(1, top + 2)):
            rest = (top + 1) * n[top + 1] / n[1]
            if rest < 1:
                kept = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, top + 1)]
                if all(0 < d < 1 for d in kept):
                    return kept
    return [0.5]


@dataclass(frozen=True)
class Level:
    """N-grams of one length: how many there are, their total and their discounts."""

    types: int
    total: int
    kept: tuple[float, ...]

    @property
    def loss(self) -> float:
        """What a count beyond the discounted ones loses."""
        return min(r * (1 - d) for r, d in enumerate(self.kept, 1))

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        small = np.array([0.0, *(r * d for r, d in enumerate(self.kept, 1))])
        return np.where(counts < len(small), small[np.minimum(counts, len(small) - 1)], counts - self.loss)


@dataclass(frozen=True)
class Model:
    levels: dict[int, Level]
    texts: int
    unknown: float


def fitted(stats: dict[int, list[int]], texts: int) -> Model:
    """The model's numbers from the buckets' statistics, summed by length."""
    levels = {m: Level(s[0], s[1], tuple(discounts(s[2:]))) for m, s in stats.items()}
    words = levels[1]
    small = dict(enumerate(stats[1][2:], 1))
    beyond = words.types - sum(small[r] for r in range(1, len(words.kept) + 1))
    left = sum(small[r] * r * (1 - d) for r, d in enumerate(words.kept, 1)) + beyond * words.loss
    return Model(levels, texts, left / words.total if words.total else 1.0)


SCORED = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("at", pa.int32()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()), ("m", pa.int32()), ("context", pa.int64()), ("left", pa.float64()), ("lower", pa.float64()),
    ("asked", pa.int64()),
])


def _evaluate(order: int, model: Model, id_type: pa.DataType):
    """A function from a block and its answers, in any order, to rows of SCORED and id: 0 a text,
    with all of its score but what it asks for; 1 a context's part of its weight and how many
    texts of the block ask for it; 2 a text's asking for a context `asked` times."""
    schema = SCORED.append(pa.field("id", id_type))

    def rows(block: int, columns: dict) -> Iterator[pa.RecordBatch]:
        size = len(columns["kind"])
        columns["block"] = np.full(size, block)
        for i in range(0, size, ROWS):
            n = min(ROWS, size - i)
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[f.name][i : i + n], type=f.type, from_pandas=False) if f.name in columns else pa.nulls(n, f.type) for f in schema
            ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, replies = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["stream"] is None:
                    replies.append((r["bucket"], r["m"], r["counts"]))
                else:
                    row = r
        parts = {m: [unpack(c) for _, k, c in sorted(replies) if k == m] for m in range(1, order + 1)}
        del batch, r, replies
        met = {m: [] for m in parts}
        for _, texts in _slices(row, order):
            for m in met:
                met[m].append(texts.distinct(m))
        distinct, total, own = {}, {}, {}  # of each length; own: the n-grams of this block that aren't yet seen to
        for m in parts:
            distinct[m] = _merged(met.pop(m))
            reply = np.concatenate(parts[m] or [np.zeros(0, np.uint64)]).astype(np.int64)
            if len(reply) != len(distinct[m]):
                raise RuntimeError("a block's answers don't match what it asked for")
            total[m], own[m] = reply // 2, reply % 2 == 1
            parts[m] = None
        lost = {m: [] for m in range(2, order + 1)}  # contexts, and what own n-grams take from their weights
        wanted = {m: [] for m in range(2, order + 1)}  # contexts, once for each text that asks for them
        for begin, block in _slices(row, order):
            n, texts = len(block.text), len(block.train)
            count, before, firsts = {}, {}, {}  # per place, and the context's count; a place of each n-gram that this block owns
            for m in range(1, order + 1):
                at = np.flatnonzero(block.ends(m))
                which = np.searchsorted(distinct[m], block.keys[m][at])
                count[m] = np.zeros(n, np.int64)
                count[m][at] = total[m][which]
                mine = np.flatnonzero(own[m][which])
                grams, first = np.unique(which[mine], return_index=True)
                firsts[m], own[m][grams] = at[mine[first]], False
                if m == 1:
                    before[m] = np.full(n, model.levels[1].total)
                else:
                    before[m] = np.concatenate([[0], count[m - 1][:-1]])
                    if m == 2:
                        before[m][block.place == 1] = model.texts
            token = block.place > 0
            words = model.levels[1]
            base = np.where(token, np.log10((count[1] + 1) / (words.total + words.types + 1)), 0.0)
            score, waiting, asks = np.zeros(n), token.copy(), []
            for m in range(order, 0, -1):
                here = waiting & (block.place >= m - 1)
                known = here & (count[m] > 0)
                score[known] += np.log10(model.levels[m].discounted(count[m][known])) - np.log10(before[m][known])
                waiting &= ~known
                if m > 1:
                    back = np.flatnonzero(here & ~known & (before[m] > 0))
                    score[back] -= np.log10(before[m][back])
                    asks.append((m, block.keys[m - 1][back - 1], block.text[back]))
            if waiting.any():
                score[waiting] += math.log10(model.unknown)
            per_text = lambda x: np.bincount(block.text, weights=x, minlength=texts)  # noqa: B023, E731
            yield from rows(row["block"], {
                "kind": np.zeros(texts, int), "at": np.arange(begin, begin + texts), "id": row["ids"][begin : begin + texts], "held_out": ~block.train,
                "n_tokens": per_text(token).astype(int), "n_known": per_text(token & (count[1] > 0)).astype(int),
                "base_score": per_text(base), "score": per_text(score),
            })
            for m, context, text in asks:
                # A text's equal asks as one row.
                by = np.lexsort((context, text))
                context, text = context[by], text[by]
                new = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (text[1:] != text[:-1])][: len(by)])
                times = np.diff(np.r_[new, len(by)])
                yield from rows(row["block"], {
                    "kind": np.full(len(new), 2), "at": begin + text[new], "m": np.full(len(new), m), "context": context[new].view(np.int64), "asked": times,
                })
                wanted[m].append(context[new])
                place = firsts[m]
                gone = count[m][place] - model.levels[m].discounted(count[m][place])
                lower = model.levels[m - 1].discounted(count[m - 1][place]) / before[m - 1][place]
                lost[m].append((block.keys[m - 1][place - 1], gone, lower))
        del distinct, total, own
        for m in lost:
            keys, gone, lower = map(np.concatenate, zip(*lost[m], strict=True))
            asked = np.concatenate(wanted[m])
            contexts = _merged([keys, asked])
            mine, theirs = np.searchsorted(contexts, keys), np.searchsorted(contexts, asked)
            add = lambda w, x: np.bincount(w, weights=x, minlength=len(contexts))  # noqa: B023, E731
            yield from rows(row["block"], {
                "kind": np.ones(len(contexts), int), "m": np.full(len(contexts), m), "context": contexts.view(np.int64), "left": add(mine, gone),
                "lower": add(mine, lower), "asked": np.bincount(theirs, minlength=len(contexts)),
            })
            lost[m] = wanted[m] = None

    return run


def blocks_of(df: DataFrame, id: str, text: str, train: Column) -> DataFrame:
    """The texts in blocks, written."""
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    schema = pa.schema([
        ("block", pa.int64()), ("ids", pa.list_(to_arrow_schema(rows.schema).field("id").type)), ("train", pa.list_(pa.bool_())), ("tokens", pa.int64()),
        ("words", pa.binary()), ("stream", pa.binary()),
    ])
    return written(rows.mapInArrow(_blocks(schema), from_arrow_schema(schema)), "blocks", LARGE_ROWS)


def counted(blocks: DataFrame, order: int) -> DataFrame:
    """ANSWER rows for all blocks, written: the n-gram counts, by length and bucket of hashes."""
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // BUCKET_GRAMS))
    asks = blocks.mapInArrow(_asks(order, buckets), from_arrow_schema(ASK))
    return written(asks.groupBy("m", "bucket").applyInArrow(_answer, from_arrow_schema(ANSWER)), "counts")


def fit(blocks: DataFrame, counts: DataFrame, order: int) -> Model:
    """A row of statistics per length comes to the driver."""
    places = range(K + 3)
    summed = counts.where("stats is not null").groupBy("m").agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in places]).collect()
    stats = {m: [0] * (K + 3) for m in range(1, order + 1)} | {r["m"]: [r[f"s{i}"] for i in places] for r in summed}
    texts = blocks.agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0
    return fitted(stats, texts)


def weighed(scored: DataFrame) -> DataFrame:
    """The backoff weights that are asked for, written: m, context, weight (log10, without the
    context's count, which the asking text has put in) and asked (by how many texts)."""
    sums = scored.where("kind = 1").groupBy("m", "context").agg(*[F.sum(c).alias(c) for c in ("left", "lower", "asked")]).where("asked > 0")
    return written(sums.select("m", "context", (F.log10("left") - F.log10(F.greatest(1 - F.col("lower"), F.lit(1e-300)))).alias("weight"), "asked"), "weights")


def score(df: DataFrame, train: Column, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per row of `df`: its id, held_out (not `train`), n_tokens, n_known (tokens met in
    learned texts), train_tokens, base_score (log10 with one added to each count) and score
    (the model's log10 probability of the text)."""
    if order < 1:
        raise ValueError("n-grams have one word at least")
    blocks = blocks_of(df, id, text, train)
    counts = counted(blocks, order)
    model = fit(blocks, counts, order)
    id_type = to_arrow_schema(df.select(id).schema).field(0).type
    replies = counts.where("block is not null").select("m", "bucket", "block", "counts")
    columns = from_arrow_schema(SCORED).add("id", df.schema[id].dataType)
    both = blocks.drop("tokens").unionByName(replies, allowMissingColumns=True)
    scored = written(both.groupBy("block").applyInArrow(_evaluate(order, model, id_type), columns), "scored")
    texts = scored.where("kind = 0").select(
        F.col("id").alias(id), "block", "at", "held_out", "n_tokens", "n_known", F.lit(model.levels[1].total).cast("long").alias("train_tokens"), "base_score", "score"
    )
    weights = weighed(scored)
    asks = scored.where("kind = 2").select("block", "at", "m", "context", F.col("asked").alias("times"))
    bound = (weights.agg(F.sum("asked")).first()[0] or 0) / HOT
    hot = F.broadcast(weights.where(F.col("asked") > bound))  # fewer than HOT rows
    often = asks.join(hot.select("m", "context", "weight"), ["m", "context"])
    rest = asks.join(hot.select("m", "context"), ["m", "context"], "left_anti").join(weights.select("m", "context", "weight"), ["m", "context"])
    owed = often.union(rest).groupBy(F.col("block").alias("b"), F.col("at").alias("a")).agg(F.sum(F.col("times") * F.col("weight")).alias("owed"))
    return texts.join(owed, (F.col("block") == F.col("b")) & (F.col("at") == F.col("a")), "left").select(
        id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", (F.col("score") + F.coalesce("owed", F.lit(0.0))).alias("score")
    )

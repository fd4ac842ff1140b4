"""Periodic runs of words, found by uniting suffix classes from the longest prefix down.

The suffixes of a text are sorted by prefix doubling; their longest common prefixes (LCP)
come from one pass over the text. Kruskal's order then unites neighbouring suffixes by
decreasing LCP, each class being an ordered set of positions, the smaller put into the
larger. When a union at LCP l makes positions i < j neighbours of one class, the words from
i on repeat at distance q = j - i for q + l words. With q <= l that is a stretch of two or
more periods, and q is its smallest period: were there a smaller one, the position a period
after i would share a longer prefix with i, be in the class already and lie between the
two. So a run is seeded once, where the word before i differs from that before j.

A union below LCP `least / 2` can't seed a run of `least` words, so Kruskal stops there,
and only suffixes that share so many words with another one are sorted to the end. Texts
of a batch are handled together; a word of one text is never that of another. Memory is in
proportion to a batch's words, or to one text's where that is larger.

Null and empty texts have no words and no runs; texts that are nothing but one repeated
word, however long, are a run of period one; repeated rows get each their result; an empty
table gives an empty one; input columns all stay.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tillstar.llm.common import with_text_column

LEAST = 12
#: Words handled at a time; longer texts are handled alone.
BUNCH_WORDS = 200_000

RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
RESULT = StructType([StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])


class Positions:
    """An ordered set of numbers in blocks, so that insertion moves few of them."""

    BLOCK = 2048

    def __init__(self, first: int):
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Puts x in; its neighbours."""
        b = max(0, bisect_left(self.firsts, x) - 1)
        block = self.blocks[b]
        at = bisect_left(block, x)
        before = block[at - 1] if at else None
        after = block[at] if at < len(block) else self.firsts[b + 1] if b + 1 < len(self.firsts) else None
        block.insert(at, x)
        self.firsts[b] = block[0]
        self.size += 1
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.firsts.insert(b + 1, block[half])
            del block[half:]
        return before, after


def suffix_order(words: np.ndarray, least: int) -> tuple[np.ndarray, int]:
    """The suffixes that share so many words with another one, in order, and that number:
    a power of two, `least` at most.

    `words` are numbers from 0 without gaps; suffixes of equal words must not reach the end.
    """
    n = len(words)
    counts = np.bincount(words)
    rank = (np.cumsum(counts) - counts)[words].astype(np.int64)
    live = np.flatnonzero(counts[words] > 1)
    kept, width, sure = None, 1, 0
    while len(live):
        if kept is None and 2 * width > least:
            kept, sure = live, width
        second = rank[np.minimum(live + width, n - 1)]
        order = np.lexsort((second, rank[live]))
        live, second = live[order], second[order]
        first = rank[live]
        new_first = np.r_[True, first[1:] != first[:-1]]
        new = new_first | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(live))
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank[live] = first + start - np.maximum.accumulate(np.where(new_first, at, 0))
        alone = new & np.r_[new[1:], True]
        live, width = live[~alone], 2 * width
    if kept is None:
        return np.zeros(0, np.int64), sure
    return kept[np.argsort(rank[kept], kind="stable")], sure


def prefix_lengths(words: Sequence[int], order: np.ndarray, sure: int) -> np.ndarray:
    """Of each suffix in `order`, the words it shares with the one before it there.

    The suffix after one that shares l words shares l - 1 at least, if that is `sure` or
    more: else the one before it in the order of all suffixes may be missing here.
    """
    found, last, shared = {}, -2, 0
    before = dict(zip(order[1:].tolist(), order[:-1].tolist(), strict=True))
    for i in sorted(before):
        j = before[i]
        shared = shared - 1 if i == last + 1 and shared > sure else 0
        while words[i + shared] == words[j + shared]:
            shared += 1
        found[i], last = shared, i
    return np.array([found[i] for i in order[1:].tolist()], np.int64)


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order of start and period.

    The last word must occur once, so must the words that end texts laid end to end.
    """
    floor = -(-least // 2)
    order, sure = suffix_order(words, floor)
    if len(order) < 2:
        return []
    plain = words.tolist()
    shared = prefix_lengths(plain, order, sure)
    root: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    runs = []
    for k in np.argsort(-shared, kind="stable").tolist():
        lcp = int(shared[k])
        if lcp < floor:
            break
        a, b = find(int(order[k])), find(int(order[k + 1]))
        large, small = sets.pop(a, None) or Positions(a), sets.pop(b, None) or Positions(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        root[b] = a
        sets[a] = large
        mine = list(small)
        for n, x in enumerate(mine):
            before, after = large.add(x)
            # Neighbours that were in one set before aren't new; the next of `mine` may come between.
            pairs = []
            if before is not None and (n == 0 or before != mine[n - 1]):
                pairs.append((before, x))
            if after is not None and (n + 1 == len(mine) or after < mine[n + 1]):
                pairs.append((x, after))
            for i, j in pairs:
                q = j - i
                if q <= lcp and q + lcp >= least and (i == 0 or plain[i - 1] != plain[j - 1]):
                    runs.append((i, q + lcp, q))
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def _bunches(texts: list[str]):
    """Lists of word lists, of about BUNCH_WORDS words."""
    bunch, size = [], 0
    for text in texts:
        words = text.encode().split()  # of bytes: ASCII white space alone
        if bunch and size + len(words) > BUNCH_WORDS:
            yield bunch
            bunch, size = [], 0
        bunch.append(words)
        size += len(words)
    if bunch:
        yield bunch


def analyse(texts: list[str], least: int = LEAST) -> list[dict]:
    """Rows of RESULT for a batch of texts."""
    out = []
    for bunch in _bunches(texts):
        ids, starts, free = [], [], 0
        for words in bunch:
            starts.append(len(ids))
            number: dict[bytes, int] = {}
            ids += [number.setdefault(w, free + len(number)) for w in words]
            free += len(number)
            ids.append(free)  # ends this text, as no other word does
            free += 1
        found: list[list[tuple[int, int, int]]] = [[] for _ in bunch]
        text = 0
        for start, length, period in find_runs(np.array(ids, np.int64), least):
            while text + 1 < len(starts) and starts[text + 1] <= start:
                text += 1
            found[text].append((start - starts[text], length, period))
        for words, runs in zip(bunch, found, strict=True):
            out.append({
                "n_words": len(words),
                "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs],
                "collapsed": b" ".join(_first_periods(words, runs)).decode(),
            })
    return out


def _first_periods(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        change[s + q] += 1
        change[s + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def with_runs(df: DataFrame, text: str = "text", least: int = LEAST) -> tuple[DataFrame, str]:
    """`df` with a struct column (its name is returned too): n_words, runs (start, length and
    period in words, by start, then period) and collapsed, the text's words but those that a
    run contains after its first period, joined by spaces."""
    if least < 2:
        raise ValueError("a run has two words at least")
    return with_text_column(df, text, "periodic", RESULT, lambda: lambda texts: analyse(texts, least))

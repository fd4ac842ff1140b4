"""Token counts by a linear longest-match automaton.

Greedy word pieces take, again and again, the longest piece of the vocabulary that a word
goes on with. The vocabulary is a trie, its nodes reached by whole prefixes. Where a node
has no edge for the next character, its failure link leads to where the automaton would
stand had it popped the longest pieces off what it has read; how many pieces that pops is
computed beforehand. So a word costs a number of steps linear in its length, and its
pieces are counted without ever being built. A word that can't be matched to its end
counts as one unknown token.

Words are runs without ASCII white space, each taken with the vocabulary's mark for word
beginnings before it. Null and empty texts have no
tokens; rows that repeat are counted each for itself; input columns all stay.
"""

from __future__ import annotations

import functools
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from tillstar.llm.common import with_text_column

RESULT = StructType([StructField("n_words", LongType()), StructField("n_tokens", LongType()), StructField("n_unknown", LongType())])
#: Words whose count a worker remembers; forgotten all at once beyond that.
REMEMBERED = 200_000
NONE = -1


class Automaton:
    """Counts the greedy pieces of words."""

    def __init__(self, vocabulary):
        self.edges: list[dict[str, int]] = [{}]
        self.accepts: list[bool] = [False]
        for piece in vocabulary:
            node = 0
            for char in piece:
                if char not in self.edges[node]:
                    self.edges[node][char] = len(self.edges)
                    self.edges.append({})
                    self.accepts.append(False)
                node = self.edges[node][char]
            self.accepts[node] = node > 0
        self._link()

    def _link(self) -> None:
        """fails[v]: where to go on after popping; pops[v]: how many pieces that pops."""
        self.fails = [NONE] * len(self.edges)
        self.pops = [0] * len(self.edges)
        todo = deque([0])
        while todo:
            at = todo.popleft()
            for char, node in self.edges[at].items():
                if self.accepts[node]:
                    self.fails[node], self.pops[node] = 0, 1
                else:
                    over, popped = self.fails[at], self.pops[at]
                    while over != NONE and char not in self.edges[over]:
                        popped += self.pops[over]
                        over = self.fails[over]
                    if over != NONE:
                        self.fails[node], self.pops[node] = self.edges[over][char], popped
                todo.append(node)

    def count(self, word: str) -> int:
        """The number of pieces of `word`, or 0 where it can't be matched to its end."""
        edges, fails, pops = self.edges, self.fails, self.pops
        node = total = 0
        for char in word:
            while char not in edges[node]:
                total += pops[node]
                node = fails[node]
                if node == NONE:
                    return 0
            node = edges[node][char]
        while node > 0:
            total += pops[node]
            node = fails[node]
        return 0 if node == NONE else total


def pieces_of(vocabulary: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file: no unknown, control or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]


@functools.cache
def load(vocabulary: str) -> Automaton:
    """The automaton of a sentencepiece file; made once per worker process."""
    return Automaton(pieces_of(vocabulary))


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", mark: str = "▁") -> tuple[DataFrame, str]:
    """`df` with a struct column (n_words, n_tokens, n_unknown), and that column's name."""

    def make():
        automaton = load(vocabulary)
        known: dict[str, int] = {}

        def one(text: str) -> dict:
            words = [w.decode() for w in text.encode().split()]
            total = unknown = 0
            for word in words:
                n = known.get(word)
                if n is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    n = known[word] = automaton.count(mark + word)
                total += n or 1
                unknown += not n
            return {"n_words": len(words), "n_tokens": total, "n_unknown": unknown}

        return lambda texts: [one(t) for t in texts]

    return with_text_column(df, text, "tokens", RESULT, make)

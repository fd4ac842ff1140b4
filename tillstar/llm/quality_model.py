"""Quality classifier: attention over the passages of a document.

A document is a bag of passages. Each passage is encoded (how its characters follow one
another by class, how its words repeat), mapped to a hidden vector, and given a gated
attention weight; the weighted sum of the hidden vectors is the document's
representation, and a logistic score is read off that. Only documents carry labels; what
passages to look at is learned with the rest.

Training takes a bounded sample (`SAMPLE` labelled documents, chosen by hash) to the
driver, as passage codes; every document is scored where it lies, from all its passages.

Null and empty texts are one passage of zeros and get the score of that; repeated rows are
scored each for itself; an empty table gives an empty one; input columns all stay. With
no labelled documents, or labels all alike, scores are the share of positive labels (one
half without any).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from tillstar.llm.common import with_text_column

PASSAGE_WORDS = 64
#: Labelled documents that the model is fitted to, about; twice as many at most.
SAMPLE = 4000
HIDDEN, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.005, 1e-3
THRESHOLD = 0.7

LOWER, UPPER, DIGIT, SPACE, STOP, SHOUT, SYMBOL, OTHER = range(8)


def _class_of(byte: int) -> int:
    c = chr(byte)
    if byte >= 128:
        return OTHER
    if c.isalpha():
        return UPPER if c.isupper() else LOWER
    return DIGIT if c.isdigit() else SPACE if c <= " " else STOP if c in ".,;:?'\"()-" else SHOUT if c == "!" else SYMBOL


CLASSES = bytes(_class_of(b) for b in range(256))
WIDTH = 64 + 6


def encode(text: str, size: int = PASSAGE_WORDS) -> np.ndarray:
    """A row of features for each passage of `size` words; the last may be shorter."""
    words = text.encode().split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    parts = [words[i : i + size] for i in range(0, len(words), size)]
    joined = [b" ".join(p) for p in parts]
    lengths = np.array([len(j) for j in joined])
    codes = np.frombuffer(b"".join(joined).translate(CLASSES), np.uint8).astype(np.int64)
    place = np.repeat(np.arange(len(parts)), lengths)
    inside = place[:-1] == place[1:]
    pairs = (place[:-1] * 64 + codes[:-1] * 8 + codes[1:])[inside]
    out = np.empty((len(parts), WIDTH), np.float32)
    out[:, :64] = np.bincount(pairs, minlength=64 * len(parts)).reshape(-1, 64) / lengths[:, None]
    for row, part, length in zip(out, parts, lengths, strict=True):
        n = len(part)
        times = Counter(part)
        heads = Counter(w[:3] for w in part)
        row[64:] = (
            len(times) / n, max(times.values()) / n, sum(map(eq, part, part[1:])) / n, length / n / 10, np.log1p(n) / 4, len(heads) / n,
        )
    return out


@dataclass(frozen=True)
class Model:
    """Standardisation and weights; `constant` stands in where nothing could be learned."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
        x = np.clip((np.concatenate(bags) - self.mean) / self.spread, -8, 8)
        return _forward(x, starts, self.weights)["p"]


def _forward(x: np.ndarray, starts: np.ndarray, w: dict) -> dict:
    """All that a pass over bags (rows of x from each start on) computes."""
    sizes = np.diff([*starts, len(x)])
    hidden = np.tanh(x @ w["in"] + w["in0"])
    told = np.tanh(hidden @ w["told"])
    gate = 1 / (1 + np.exp(-(hidden @ w["gate"])))
    raw = (told * gate) @ w["look"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), sizes))
    weight = raw / np.repeat(np.add.reduceat(raw, starts), sizes)
    bag = np.add.reduceat(hidden * weight[:, None], starts)
    p = 1 / (1 + np.exp(-(bag @ w["out"] + w["out0"])))
    return {"hidden": hidden, "told": told, "gate": gate, "weight": weight, "bag": bag, "p": p, "sizes": sizes}


def _gradient(x: np.ndarray, starts: np.ndarray, y: np.ndarray, w: dict) -> dict:
    f = _forward(x, starts, w)
    to_logit = (f["p"] - y) / len(y)
    to_bag = np.repeat(to_logit[:, None] * w["out"], f["sizes"], axis=0)
    to_weight = (f["hidden"] * to_bag).sum(1)
    mean = np.repeat(np.add.reduceat(f["weight"] * to_weight, starts), f["sizes"])
    to_raw = f["weight"] * (to_weight - mean)
    to_gated = to_raw[:, None] * w["look"]
    to_told = to_gated * f["gate"] * (1 - f["told"] ** 2)
    to_gate = to_gated * f["told"] * f["gate"] * (1 - f["gate"])
    to_hidden = f["weight"][:, None] * to_bag + to_told @ w["told"].T + to_gate @ w["gate"].T
    to_in = to_hidden * (1 - f["hidden"] ** 2)
    return {
        "in": x.T @ to_in, "in0": to_in.sum(0), "told": f["hidden"].T @ to_told, "gate": f["hidden"].T @ to_gate,
        "look": (f["told"] * f["gate"]).T @ to_raw, "out": f["bag"].T @ to_logit, "out0": to_logit.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """Adam on the logistic loss, with decayed weights."""
    if not len(labels) or labels.min() == labels.max():
        zero = np.zeros(WIDTH)
        return Model(zero, zero + 1, {}, float(labels.mean()) if len(labels) else 0.5)
    random = np.random.default_rng(seed)
    rows = np.concatenate(bags).astype(np.float64)
    mean, spread = rows.mean(0), rows.std(0) + 1e-3
    bags = [np.clip((b - mean) / spread, -8, 8) for b in bags]
    scale = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {
        "in": scale(WIDTH, HIDDEN), "in0": np.zeros(HIDDEN), "told": scale(HIDDEN, ATTENTION), "gate": scale(HIDDEN, ATTENTION),
        "look": scale(ATTENTION), "out": scale(HIDDEN), "out0": np.zeros(1),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            part = [bags[i] for i in chosen]
            starts = np.cumsum([0, *(len(b) for b in part[:-1])])
            slope = _gradient(np.concatenate(part), starts, labels[chosen], w)
            step += 1
            for k in w:
                g = slope[k] + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, w)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE) -> Model:
    """The model of a bounded sample of the rows of `docs` that have a label in `labels`."""
    step = max(1, -(-labels.where(F.col(label).isNotNull()).count() // most))
    chosen = lambda column: F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(step)) == 0
    marks = labels.where(F.col(label).isNotNull() & chosen(id)).select(F.col(id).alias("marked"), F.col(label).cast("double").alias("y"))
    known = docs.where(chosen(id)).select(id, text).join(marks, F.col(id) == F.col("marked")).select(id, "y", text)
    coded, at = with_text_column(known, text, "codes", BinaryType(), lambda: lambda texts: [encode(t).tobytes() for t in texts])
    rows = coded.select(id, "y", at).limit(2 * most).collect()  # `most` documents or so, as passage codes
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    return fit([np.frombuffer(r[2], np.float32).reshape(-1, WIDTH) for r in rows], np.array([r[1] for r in rows]))


def with_score(df: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """`df` with a column of scores (0 to 1), and its name."""

    def make():
        return lambda texts: [
            float(s) for at in range(0, len(texts), 256) for s in model.scores([encode(t) for t in texts[at : at + 256]])
        ]

    return with_text_column(df, text, "score", DoubleType(), make)

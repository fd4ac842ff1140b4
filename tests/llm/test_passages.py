"""The quality score by plain loops over bytes, passages and attention weights."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tillstar.llm import quality_model, queries

WIDTH, SIZE = quality_model.WIDTH, quality_model.PASSAGE_WORDS


def byte_class(b):
    c = chr(b)
    if b >= 128:
        return 7
    if c.isalpha():
        return 1 if c.isupper() else 0
    if c.isdigit():
        return 2
    return 3 if c <= " " else 4 if c in ".,;:?'\"()-" else 5 if c == "!" else 6


def features(words):
    text = b" ".join(words)
    row = [0.0] * WIDTH
    for a, b in zip(text, text[1:]):
        row[byte_class(a) * 8 + byte_class(b)] += 1 / len(text)
    n = len(words)
    row[64:] = [
        len(set(words)) / n, max(words.count(w) for w in words) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        len(text) / n / 10, math.log(1 + n) / 4, len({w[:3] for w in words}) / n,
    ]
    return row


def score(text, model):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    rows = [features(words[i : i + SIZE]) for i in range(0, len(words), SIZE)] or [[0.0] * WIDTH]
    w = model.weights
    hidden, looks = [], []
    for row in rows:
        x = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(row, model.mean, model.spread)]
        h = [math.tanh(w["in0"][j] + sum(x[i] * w["in"][i, j] for i in range(WIDTH))) for j in range(len(w["in0"]))]
        look = 0.0
        for k in range(len(w["look"])):
            told = math.tanh(sum(h[j] * w["told"][j, k] for j in range(len(h))))
            gate = 1 / (1 + math.exp(-sum(h[j] * w["gate"][j, k] for j in range(len(h)))))
            look += told * gate * w["look"][k]
        hidden.append(h)
        looks.append(look)
    total = sum(math.exp(v) for v in looks)
    bag = [sum(math.exp(v) / total * h[j] for v, h in zip(looks, hidden)) for j in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-(w["out0"][0] + sum(b * o for b, o in zip(bag, w["out"])))))


def test_scores_of_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality")
    held_out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    known = [r["doc_id"] for r in labels.collect() if not held_out(r["doc_id"])]
    model = quality_model.train(docs, labels.where(labels.doc_id.isin(known)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in queries.op4_attention_passages(spark, small).collect()}
    assert got.keys() == texts.keys()
    short = sorted(i for i, t in texts.items() if len(t or "") < 1500)
    for i in random.Random(1).sample(short, 40):
        r = got[i]
        assert r["score"] == pytest.approx(score(texts[i], model), abs=1e-4)
        assert r["held_out"] == held_out(i) and r["predicted"] == (r["score"] >= 0.7)


def test_attention_tells_passages_apart():
    """Few bad words among many good ones: the passage that has them decides by its weight."""
    rnd = random.Random(2)
    good = lambda n: " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    bad = lambda n: " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(9)) for _ in range(n))
    texts = [good(300) if i % 2 else f"{good(200)} {bad(64)} {good(100)}" for i in range(300)]
    bags = [quality_model.encode(t) for t in texts]
    y = np.array([i % 2 for i in range(300)], float)
    model = quality_model.fit(bags[:200], y[:200])
    p = model.scores(bags[200:])
    assert ((p > 0.5) == (y[200:] == 1)).mean() > 0.95
    for t, s in list(zip(texts[200:], p))[:6]:
        assert s == pytest.approx(score(t, model), abs=1e-4)
    assert score(None, model) == pytest.approx(model.scores([quality_model.encode("")])[0], abs=1e-6)

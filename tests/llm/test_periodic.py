"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import zlib

import brute
import pytest
from pyspark.sql import functions as F

from tillstar.llm import periodic_runs, queries


def all_runs(w, least=12):
    """Every period's maximal stretches, but those that a smaller period repeats."""
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q) and not any(w[i : i + size - p] == w[i + p : i + size] for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = brute.WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = all_runs(w)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
        sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_words(least):
    rnd = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(4):
            n, letters = rnd.randint(0, 70), "abcdefgh"[: rnd.choice([1, 2, 2, 3, 5])]
            w = [rnd.choice(letters) for _ in range(n)]
            if n and rnd.random() < 0.5:
                a = rnd.randrange(n)
                p = 1 + rnd.randrange(max(1, (n - a) // 2))
                w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            texts.append(" ".join(w))
        for text, got in zip(texts, periodic_runs.analyse(texts, least), strict=True):
            assert [tuple(r.values()) for r in got["runs"]] == all_runs(text.split(), least), text


def test_long_sets_and_bunches(monkeypatch):
    monkeypatch.setattr(periodic_runs.Positions, "BLOCK", 4)
    monkeypatch.setattr(periodic_runs, "BUNCH_WORDS", 50)
    short, long = "a b " * 40, "x " + "p q r " * 900 + "p q p"
    rows = periodic_runs.analyse([short, "", long, short])
    assert [[tuple(r.values()) for r in row["runs"]] for row in rows] == [[(0, 80, 2)], [], [(1, 2702, 3)], [(0, 80, 2)]]
    assert rows[2]["collapsed"] == "x p q r p" and rows[1]["collapsed"] == ""


def test_one_word_repeated_is_linear():
    assert periodic_runs.analyse(["na " * 150_000])[0]["runs"] == [{"start": 0, "length": 150_000, "period": 1}]


def test_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    short = sorted(d for d in docs if len(d[1] or "") < 6000)
    assert len(short) > 100
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, small).collect()}
    assert got.keys() == {i for i, _ in docs}
    for d in short:
        assert got[d[0]] == expected(*d)
    assert sum(r[1] > 0 for r in got.values()) >= 5


def test_odd_rows(odd, nothing):
    out, at = periodic_runs.with_runs(odd.withColumn("periodic", F.lit("own")))
    assert at == "periodic_" and out.columns == [*odd.columns, "periodic", at]
    for r in out.collect():
        assert r[at]["n_words"] == len(brute.WORD.findall(r["text"] or "")) and r["periodic"] == "own"
    assert periodic_runs.with_runs(nothing)[0].count() == 0
    made = queries.made_periodic(odd.select("doc_id", "text"))
    for r in made.join(odd.select("doc_id", F.col("text").alias("before")), "doc_id").where("doc_id in (4, 5, 6, 9)").collect():
        assert (r["text"] or "").split() == (r["before"] or "").split() or len(r["text"].split()) == len(r["before"].split())

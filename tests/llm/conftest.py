import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

LONG = " ".join(f"word{i % 977}x{i}" for i in range(120_000))
PROSE = "Every morning the harbour filled with small boats, and people from the hills came down to trade wool for salt. " * 1
CLEAN = " ".join(f"{w}{i}" for i, w in enumerate((PROSE * 5).split()))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls anywhere, empty and very long texts, ties, repeated rows and clashing names."""
    rows = [
        (1, CLEAN, "en", "a"), (1, CLEAN, "en", "a"), (2, CLEAN, "en", "b"), (3, CLEAN + " end", None, None),
        (4, None, "en", "a"), (5, "", "en", "b"), (6, " \t\n ", "en", "b"), (None, CLEAN, "en", "c"), (None, None, None, None),
        (7, LONG, "de", "a"), (8, "a" * 200_000, "de", ""), (9, "one two", "fr", None), (1, "other text, same id", "fr", "c"),
        (10, "mail a.b@c.de or +49 30 1234 5678, 10.0.0.1; 4111 1111 1111 1111 under the MIT License. <|endoftext|> \U0001f600é", "en", "c"),
    ]
    clash = ["id", "key", "quality", "spans", "score", "tokens", "fingerprint", "fp", "pieces", "piece", "size", "bucket", "words", "pos", "source_size", "mix_id"]
    return spark.createDataFrame(
        [(*r, *[f"own {c}" for c in clash]) for r in rows],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in clash),
    )


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]

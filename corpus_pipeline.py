"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it has written and decides about all of it:
documents that fail the quality rules go; of near duplicates one stays; personal data is
replaced; sources are mixed to their weights, so that a document goes or is repeated; the
rest is packed. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import mixing, packing, pii, quality_rules, simhash
from tillstar.llm.common import read_table, written

#: No SQL has zstandard ratios, SimHash fingerprints or byte-pair encoding; tests/llm holds
#: the pipeline against a brute-force version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=False
    )
    return packing.pack(written(cut, "pieces"))


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

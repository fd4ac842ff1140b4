"""The operators' queries: each applies one to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    conversations, embeddings, html_model, katz, licenses, mixing, oracle, packing, periodic_runs, pii, quality_model, quality_rules, simhash, wordpiece,
)
from tillstar.llm.common import read_table, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_zstd_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and zstandard bands of every document."""
    docs, at = quality_rules.quality_rules(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", f"{at}.*")


def op2_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op3_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the trees add."""
    docs, at = pii.with_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter(at, lambda s: s["base"] == 1)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return docs.select(
        "doc_id",
        *[F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col(at)).alias("spans"),
    )


def op4_attention_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out quarter."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality_model.train(docs, labels.where(~held_out))
    scored, at = quality_model.with_score(docs, model)
    predicted = (F.col(at) >= quality_model.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col(at).alias("score"), predicted.alias("predicted"))


def op5_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op6_exact_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(written(packing.pieces(docs, VOCABULARY, RANKS, keep_ids=False), "pieces"))


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by a mix of the sources 5 : 2 : 1."""
    dealt = mixing.mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return dealt.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_tree_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages, at = html_model.with_main_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", F.col(at).alias("text"), F.length(at).cast("long").alias("n_chars"))


def op9_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every embedding."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op10_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    docs, at = wordpiece.token_counts(read_table(spark, sf_dir, "documents", "doc_id", "text"), PIECES)
    return docs.select("doc_id", f"{at}.*")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults by the checksum of `conv_id:turn` (nulls: one space)."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    role = F.when(fault == 4, "user").otherwise(plain("role"))
    return rows.where(fault != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    )


def op11_persistent_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, its rows damaged before."""
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    summaries, parts = conversations.repair(damaged(rows))
    found = summaries.withColumnRenamed("conv_id", "of").join(
        conversations.digests(parts).withColumnRenamed("conv_id", "by"), F.col("of").eqNullSafe(F.col("by"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *[zero(c) for c in ("gaps", *conversations.COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned outside the held-out seventh."""
    learned = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    return katz.score(read_table(spark, sf_dir, "documents", "doc_id", "text"), learned)


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth text's words repeating from some word on; texts without
    an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
    repeated = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", (a + (i - a) % p).cast("int"))))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    hit = F.coalesce(h % 10 == 0, F.lit(False))
    # Words of other texts aren't split here.
    docs = docs.select("doc_id", "text", F.when(hit, words).alias("words"))
    return docs.select("doc_id", F.when(F.size("words") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some made periodic before."""
    docs, at = periodic_runs.with_runs(made_periodic(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    runs = F.col(at)["runs"]
    # The longest; of these the first, then that of the smallest period.
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return docs.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best["start"].alias("start"), (-best["size"]).alias("length"),
        best["period"].alias("period"), F.floor(-1000 * best["size"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col(at)["collapsed"], 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_zstd_bands, op2_diagonal_voting, op3_candidate_boosting, op4_attention_passages, op5_simhash_popcount,
        op6_exact_complements, op7_entropy_mixing, op8_tree_marginals, op9_product_quantisation, op10_longest_match_counts, op11_persistent_audits,
        op12_katz_backoff, op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {
    "op2_diagonal_voting": oracle.LICENSES,
    "op9_product_quantisation": oracle.EMBEDDINGS,
}

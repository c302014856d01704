"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm import audit, centroids, decontam, exact, langid, oracle, packing, pseudo, quality, records, rules, shards, simhash, toxicity
from trafficlens.llm.common import crc_remainder, fresh, table
from trafficlens.session import scratch_path


def _held_out(modulus: int, remainder: int):
    return F.coalesce(crc_remainder(F.col("doc_id"), modulus) == remainder, F.lit(False))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and benchmark items of every document."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learned(docs, labels.where(~_held_out(5, 0)))
    out = quality.scored(docs.select("doc_id", "text"), model, "score")
    return out.select("doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learned(docs, labels.where(~_held_out(5, 0)))
    out = toxicity.scored(docs.select("doc_id", "text"), model, "score")
    return out.select("doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learned(docs.where(~_held_out(4, 2)))
    out = langid.predicted(docs.select("doc_id", "text"), model, "p")
    return out.select("doc_id", _held_out(4, 2).alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from the binary files."""
    from public_tokenizers import path

    out = records.written_and_indexed(table(spark, sf_dir, "documents"), scratch_path(spark, "records"), path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by the rebalanced slot map; shards hold
    near equal bytes."""
    out = shards.sharded(table(spark, sf_dir, "documents"), scratch_path(spark, "slot-map"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and adaptive verdict of every document."""
    out = rules.judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document."""
    return pseudo.scored(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes at each step of every order, per language."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every embedding."""
    return centroids.digest(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and which row of it stays."""
    out = exact.duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents without letters or without a main language go."""
    model = langid.learned(docs.where(~_held_out(4, 2)))
    p = fresh(docs, "p")
    return langid.predicted(docs, model, p).where(langid.accepted(F.col(p))).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents scored 0.5 or more go."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learned(docs, labels.where(~_held_out(5, 0)))
    p = fresh(docs, "p")
    return toxicity.scored(docs, model, p).where(F.col(p) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: of each component the document with the smallest doc_id stays."""
    return simhash.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents with a benchmark passage go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: length buckets and batches of what is left."""
    return packing.packed(docs)


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_quality, op3_toxicity, op4_language, op5_simhash, op6_records, op7_shards, op8_quality_rules,
    op9_pseudo_likelihood, op10_packing, op11_filter_audit, op12_centroids, op13_exact_dedup)}

SQL = {
    "op1_decontamination": oracle.DECONTAMINATION,
    "op8_quality_rules": oracle.rules(rules.METRICS, rules.MARGIN, rules.LEAST_ROWS, rules.REACH, rules.BITS),
    "op11_filter_audit": oracle.FILTER_AUDIT,
    "op12_centroids": oracle.centroids(40, 5, 64),
    "op13_exact_dedup": oracle.EXACT_DEDUP,
}

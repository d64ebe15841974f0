"""One registered query per training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    bpe, ctw, edits, embed_join, hard_negatives, jaccard_join, maxscore, mixing, oracles as sql, pii, resampling, sharding, substring, toxicity,
)
from tidewatch.session import table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_vector_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = embed_join.join_vectors(_table(spark, sf_dir, "embeddings"))
    return links.select("vec_id", "n_links", "component_id", "kept")


def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_links", "class_id")


def op3_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op4_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         "threshold", "flagged")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"))


def op7_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "epochs")


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    scored = ctw.score(_table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"))


def op11_consistent_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = edits.edited_fingerprints(_table(spark, sf_dir, "documents"))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return prints.select("doc_id", "n_chars", "edited_sha256", text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next")


def op12_residue_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=1)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_vector_range_join, op2_chosen_path_join, op3_label_propagation_shards, op4_maxscore_top_k, op5_toxicity, op6_pii,
        op7_mixed_sources, op8_repeated_passages, op9_context_tree_weighting, op10_bpe, op11_consistent_weighted_sampling,
        op12_residue_hard_negatives, op13_importance_resampling,
    )}


def oracles() -> dict[str, str]:
    return {
        "op1_vector_range_join": sql.VECTOR_LINKS,
        "op2_chosen_path_join": sql.JACCARD_GROUPS,
        "op4_maxscore_top_k": sql.TOP_PRODUCTS,
        "op7_mixed_sources": sql.MIX,
        "op8_repeated_passages": sql.REPEATS,
        "op12_residue_hard_negatives": sql.HARD_NEGATIVES,
        "op13_importance_resampling": sql.RESAMPLED,
    }

"""The registered queries of the corpus operators, with production parameters over whole
tables, and the SQL beside them. Operators without SQL cannot be written in it in whole:
they are tested against brute force, round trips or held-out labels in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundpanel.llm import ann, bpe, codes, collocations, html, language, lines, near_dups, ngram_join, packing, quality, sharding, toxicity
from fundpanel.llm.common import staged, table

SQL: dict[str, str] = {
    "op8_ngram_join": f"SELECT doc_id, n_shingles, component_id FROM ({near_dups.oracle(ngram_join.WORDS, ngram_join.PERCENT)})",
    "op11_collocation_tiles": collocations.ORACLE,
    "op12_minhash_tensor": near_dups.ORACLE,
    "op13_gnat_codes": codes.ORACLE,
}


def _fold(modulus: int) -> Column:
    """The fold of a document, by which labels are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0")).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(
        F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    net = language.fit(docs.filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), language.predicted(net, F.col("text")).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), toxicity.scored(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= toxicity.REJECT).cast("int"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return packing.pack(parts).withColumnRenamed("key", "doc_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.extract(table(spark, sf_dir, "pages"))
    return rows.select(F.col("key").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id").withColumn("grown_shard", F.lit(None).cast("int"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.similar(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(quality.measures(table(spark, sf_dir, "documents")), "measures")
    cutoffs = quality.fit(rows, table(spark, sf_dir, "labels"))
    return rows.select(
        F.col("_key").alias("doc_id"), "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        quality.base_failed("_m").alias("base_failed"), quality.verdict(cutoffs, "_m", F.col("_stratum")).alias("kept"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand earlier, and how many went."""
    return lines.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", F.crc32("text").alias("text_crc32"))


def op11_collocation_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dups.similar(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                       F.col("key").eqNullSafe(F.col("component")).alias("kept"))


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_multi_index_search, op2_bpe_chunk_reuse, op3_language_id, op4_toxicity, op5_best_fit_packing,
        op6_page_text, op7_balanced_shards, op8_ngram_join, op9_quality_rules, op10_line_dedup, op11_collocation_tiles, op12_minhash_tensor, op13_gnat_codes)
}

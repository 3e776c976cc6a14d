"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept, written as Parquet and read
back, and returns documents with the same columns; the last returns packed pieces.

1. toxicity: documents that score as toxic go;
2. quality: documents that fail the base rules or a cutoff of their stratum go;
3. lines: in texts, lines that stand earlier in the corpus go;
4. near duplicates: of each group of linked documents the one with the smallest id stays;
5. packing: pieces of at most 2048 tokens, with their sequence and place.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fundpanel.llm import lines, ngram_join, packing, quality, toxicity
from fundpanel.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(parts).withColumnRenamed("key", "doc_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("best-fit packing", pack_sequences),
]

#: Classifier, cutoffs chosen on labels, near lines and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

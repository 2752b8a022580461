"""A corpus pipeline: quality, near duplicates, repeated passages, mixing, encoding.

Each stage takes the documents its predecessor kept. All but the last return the
columns of documents. Empty tables give empty tables. Null and empty texts pass
all stages: they are scored by their measures, link with nothing, have nothing to
cut, weigh nothing in the mix (which so leaves them out). Null ids are ids like
others. Of repeated rows the near-duplicate stage keeps one. Extra columns go.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, jaccard, mixing, quality, substrings
from larder.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.classify(docs, model, out="_score").where("_score >= 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the smallest doc_id stays (null last, then table order); documents without words stay."""
    numbered = Scratch(spark).keep(docs.withColumn("_row", F.monotonically_increasing_id()), compression="zstd")
    found = jaccard.near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_row"), "n_shingles", "component_id"
    )
    # a component's key is its least row number, so rows of one doc_id but different texts stay apart
    first = (
        numbered.select("_row", "doc_id")
        .join(found.where("n_shingles > 0"), "_row")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))["_row"].alias("_row"))
    )
    kept = first.select("_row").union(found.where("n_shingles = 0").select("_row"))
    return numbered.join(kept, "_row", "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier go; a document that keeps all its words keeps its text as it is."""
    cut = substrings.remove_repeats(docs)
    # a document of which nothing is left goes
    kept = cut.where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of each document, and whether they decode to its text."""
    ranks = bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.select("doc_id", "source", bpe.n_tokens().alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: The classifier and the encoder cannot be stated in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs

"""From raw documents to token ids: quality, near duplicates, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again as the next stage's
documents.  The first three return the columns of documents.  Every row is a
document of its own, also where ids are null or repeated.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm import bpe, mixing, quality_cnn, set_join
from vitalspark.llm.row_ids import numbered
from vitalspark.session import materialize

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, doesn't reject.  A null text is empty;
    empty texts have a score like any other; without labels of both classes all rows have one score; an empty table
    stays empty."""
    docs = docs.select(COLUMNS)
    return quality_cnn.keep_good(docs, quality_cnn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id (null first; equal ids by a hash of the row) of each group of rows linked by a
    similarity of 0.75 or more.  Null and empty texts link with nothing, so all such rows stay."""
    docs = numbered(docs.select(COLUMNS))
    found, _, _ = set_join.jaccard_join(docs.select(F.col("row").alias("doc_id"), "text"), complete=False)
    found = materialize(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")), "row-components")
    # rows that are no component's smallest number, and those numbers: all rows of components of two or more
    linked = found.where("row <> component")
    linked = materialize(linked.unionByName(linked.select(F.col("component").alias("row"), "component").distinct()), "linked-rows")
    # the rows grow with the documents: one plan for every size
    about = docs.select("row", "doc_id", F.xxhash64("text", "lang", "source", "n_chars").alias("h"))
    placed = materialize(linked.join(about.hint("merge"), "row"), "linked-rows")
    first = placed.groupBy("component").agg(F.min(F.struct("doc_id", "h", "row")).alias("first")).select("first.row")
    dropped = placed.select("row").join(first.hint("merge"), "row", "left_anti").select(F.col("row").alias("dropped"))
    return docs.join(dropped.hint("merge"), docs.row == dropped.dropped, "left_anti").select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each row as the mixture takes of it.  A row without words adds nothing to any size and has the
    whole part of its source's copies; a null source is a source of its own; an empty table stays empty."""
    docs = numbered(docs.select(COLUMNS))
    copies = materialize(mixing.mix(docs, row="row").where("copies > 0").select(F.col("row").alias("taken"), "copies"), "copies")
    out = docs.join(copies.hint("merge"), docs.row == copies.taken)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the bytes decoded from them.  Null and empty texts have no
    ids; repeated rows are rows of their own; an empty table stays empty."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN, digest=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None      # a trained network and seeded rounding; tests/llm/test_pipeline.py holds each stage against brute force

"""From raw documents to packed training sequences: each stage is one of the corpus operators, written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import line_chunks, packing, quality_lines, simhash, suffix_dedup
from gridloom.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go, boilerplate lines of a host leave the others."""
    return quality_lines.clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of several lines that an earlier place has go, content-defined chunks as well as neighbouring lines; a document that is left without a word goes too."""
    out = line_chunks.remove_repeated(docs, pairs=True, chunked=True)
    return out.filter("n_lines_removed = 0 OR text RLIKE '[^ \\t\\n\\u000B\\f\\r]'").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go, and characters that are cut in two with them; so does a document with nothing left."""
    out = suffix_dedup.remove_repeats(docs, as_text=True)
    return out.filter("n_removed < n_bytes OR n_bytes = 0").withColumn("text", F.col("kept")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token pieces, each with its place in a sequence of at most 2,048 tokens."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return packing.pack(docs, f.read(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("pack", pack),
]

#: SimHash needs XXH64 and packing a tokenizer, which DuckDB has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
